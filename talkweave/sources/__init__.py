"""Readers, writers and the views that feed the jobs."""

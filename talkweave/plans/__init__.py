"""Whole jobs, and the queries that check each operator."""

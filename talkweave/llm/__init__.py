"""Operators for preparing training text, and the pipeline built from them."""

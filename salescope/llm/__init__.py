"""Operators for preparing training data: filters, deduplication, search, mixing, formatting."""

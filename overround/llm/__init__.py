"""Operators for preparing training data: search, deduplication, filters, packing and formatting."""

"""Operators for preparing training text: packing, deduplication, filters, scoring and token files."""

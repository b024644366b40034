"""Operators for preparing training text: search, archives, cleaning, deduplication, packing."""

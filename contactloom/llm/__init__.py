"""Operators for large text corpora: counting, cleaning, de-duplicating and packing."""

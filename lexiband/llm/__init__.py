"""Operators that prepare training text: deduplication, mixing, packing, extraction, scoring."""

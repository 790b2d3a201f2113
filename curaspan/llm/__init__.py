"""Operators for preparing training text: quality, packing, search, dedup, extraction, scoring."""

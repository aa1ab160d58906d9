"""Operators for preparing training text: counting, deduplication, filtering, mixing, output."""

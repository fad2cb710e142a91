"""Operators for preparing training text: filters, scoring, duplicates, packing, tokens."""

"""Operators for preparing training text: filters, near-duplicates, mixing,
packing and token files. Nothing else in the library imports this package."""

"""Operators for preparing training text at scale: rules, deduplication, filters, search, packing."""

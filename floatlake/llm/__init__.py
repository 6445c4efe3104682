"""Operators for preparing training text: filters, deduplication, extraction, packing."""

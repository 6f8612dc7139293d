"""Operators for preparing training text: deduplication, filters, personal data, tokens."""

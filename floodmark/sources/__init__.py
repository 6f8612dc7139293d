"""Readers and parsers: inventories, feature streams, lookups, predictions, demographics."""

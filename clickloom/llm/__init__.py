"""Operators for preparing training data: deduplication, filters, language, mixing, search."""

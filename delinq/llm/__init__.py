"""Operators for preparing training text: quality, formatting, tokens, mixing, duplicates, models, PII."""

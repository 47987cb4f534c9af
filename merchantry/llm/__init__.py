"""Operators for preparing training text: duplicates, extraction, search, tokens, quality, personal data, mixing, shards."""

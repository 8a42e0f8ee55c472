"""Operators for preparing training text: sharding, tokens, quality, duplicates, mixing, archives."""

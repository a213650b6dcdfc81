"""Operators for preparing training text: cleaning, deduplication, mixing, sharding, encoding.

Nothing outside this folder imports it."""

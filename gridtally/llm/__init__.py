"""Operators for preparing training text: filtering, deduplication, packing, tokens, privacy, sharding."""

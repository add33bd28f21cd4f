"""Operators that prepare training text: sharding, privacy, duplicates, packing, quality."""

"""Operators for preparing training data: sharding, token counts, archives, filters, duplicates, packing."""

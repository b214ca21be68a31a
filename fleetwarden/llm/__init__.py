"""Operators for preparing training data at scale: deduplication, packing, sharding, mixing,
nearest neighbours and language identification. Nothing outside this package imports it."""

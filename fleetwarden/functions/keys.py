"""Deterministic surrogate keys (serial / identity columns of the hub's tables).

A global ``row_number()`` would pull every row through one partition; a hash of the
natural key is computed where the row is, and is stable across re-runs and retries.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*cols) -> Column:
    """64-bit key from the natural-key columns (xxhash64; NULLs hash as a fixed value)."""
    return F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in cols])

"""Epoch helpers on the UTC wall clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_seconds(ts: Column) -> Column:
    """Epoch seconds of a TIMESTAMP_NTZ, rounded half away from zero to a whole second
    (an epoch with a fraction stored into a bigint column)."""
    us = F.unix_micros(ts.cast("timestamp"))
    shifted = F.when(us < 0, us - 500_000).otherwise(us + 500_000)
    return ((shifted - shifted % F.lit(1_000_000)) / F.lit(1_000_000)).cast("long")


def as_ntz(value) -> Column:
    """A literal or column as TIMESTAMP_NTZ."""
    c = value if isinstance(value, Column) else F.lit(value)
    return c.cast("timestamp_ntz")

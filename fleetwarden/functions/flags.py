"""Eight-bit switch columns.

A switch is stored as an int 0..255; position 0 is the most significant bit (MSB first),
so position p has mask ``1 << (7 - p)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

# Meaning of the assigned bit positions (positions 3..7 are unassigned).
BIT_REINDEX = 0b10000000       # position 0: takes part in index maintenance
BIT_MAINTENANCE = 0b01000000   # position 1: server / database for maintenance operations
BIT_LOG_REPORTS = 0b00100000   # position 2: log reports are cut on this server

_OPS = ("set", "clear", "toggle")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag_is_set(c, mask: int, dtype=None) -> Column:
    """``(switch & mask) = mask``; a boolean switch (old schema) is simply tested for true."""
    col = _col(c)
    if isinstance(dtype, BooleanType):
        return col == F.lit(True)
    return col.bitwiseAND(F.lit(mask)) == F.lit(mask)


def flag_update(c, mask: int, op: str, where: Column | None = None) -> Column:
    """Set (OR), clear (AND NOT) or toggle (XOR) ``mask`` on rows matching ``where``."""
    if op not in _OPS:
        raise ValueError(f"op must be one of {_OPS}")
    col = _col(c)
    if op == "set":
        new = col.bitwiseOR(F.lit(mask))
    elif op == "clear":
        new = col.bitwiseAND(F.lit(255 & ~mask))
    else:
        new = col.bitwiseXOR(F.lit(mask))
    if where is None:
        return new
    return F.when(where, new).otherwise(col)


def flag_bits(c) -> Column:
    """Display form of the switch: eight characters, MSB first (``bit(8)`` text)."""
    return F.lpad(F.bin(_col(c)), 8, "0")

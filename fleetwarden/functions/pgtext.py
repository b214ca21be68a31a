"""PostgreSQL text helpers re-expressed as Spark columns: identifier and literal quoting
(``format('%I')`` / ``format('%L')``) and ``pg_size_pretty``."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# PostgreSQL 17 keywords that are not "unreserved" (categories reserved,
# type/function-name and column-name, per the PostgreSQL SQL Key Words appendix). An
# identifier equal to one of these must be double-quoted.
PG_QUOTED_KEYWORDS = (
    # reserved
    "all", "analyse", "analyze", "and", "any", "array", "as", "asc", "asymmetric", "both",
    "case", "cast", "check", "collate", "column", "constraint", "create", "current_catalog",
    "current_date", "current_role", "current_time", "current_timestamp", "current_user",
    "default", "deferrable", "desc", "distinct", "do", "else", "end", "except", "false",
    "fetch", "for", "foreign", "from", "grant", "group", "having", "in", "initially",
    "intersect", "into", "lateral", "leading", "limit", "localtime", "localtimestamp", "not",
    "null", "offset", "on", "only", "or", "order", "placing", "primary", "references",
    "returning", "select", "session_user", "some", "symmetric", "system_user", "table",
    "then", "to", "trailing", "true", "union", "unique", "user", "using", "variadic", "when",
    "where", "window", "with",
    # type / function name
    "authorization", "binary", "collation", "concurrently", "cross", "current_schema",
    "freeze", "full", "ilike", "inner", "is", "isnull", "join", "left", "like", "natural",
    "notnull", "outer", "overlaps", "right", "similar", "tablesample", "verbose",
    # column name
    "between", "bigint", "bit", "boolean", "char", "character", "coalesce", "dec", "decimal",
    "exists", "extract", "float", "greatest", "grouping", "inout", "int", "integer",
    "interval", "json", "json_array", "json_arrayagg", "json_exists", "json_object",
    "json_objectagg", "json_query", "json_scalar", "json_serialize", "json_table",
    "json_value", "least", "merge_action", "national", "nchar", "none", "normalize",
    "nullif", "numeric", "out", "overlay", "position", "precision", "real", "row", "setof",
    "smallint", "substring", "time", "timestamp", "treat", "trim", "values", "varchar",
    "xmlattributes", "xmlconcat", "xmlelement", "xmlexists", "xmlforest", "xmlnamespaces",
    "xmlparse", "xmlpi", "xmlroot", "xmlserialize", "xmltable",
)

# An identifier needs no quotes when it is lower-case letters, digits and underscores,
# does not start with a digit, and is not one of the keywords above.
SAFE_IDENT_PATTERN = "^[a-z_][a-z0-9_]*$"

# pg_size_pretty: below 10 kB print bytes; then each unit is used while the value,
# counted in half-units, stays under 20 * 1024 - 1; the last unit is PB.
SIZE_UNITS = ("kB", "MB", "GB", "TB", "PB")
SIZE_BYTES_LIMIT = 10 * 1024
SIZE_HALF_UNIT_LIMIT = 20 * 1024 - 1


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quote_ident_text(name: str) -> str:
    """``format('%I', name)`` for a constant, computed once in Python."""
    if re.fullmatch(SAFE_IDENT_PATTERN[1:-1], name) and name not in PG_QUOTED_KEYWORDS:
        return name
    return '"' + name.replace('"', '""') + '"'


def quote_ident(c) -> Column:
    """``format('%I', x)``: double-quote unless the name is a plain lower-case identifier."""
    col = _col(c)
    safe = col.rlike(SAFE_IDENT_PATTERN) & ~col.isin(*PG_QUOTED_KEYWORDS)
    quoted = F.concat(F.lit('"'), F.replace(col, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(safe, col).otherwise(quoted)


def quote_literal(c) -> Column:
    """``format('%L', x)``: NULL prints as NULL; quotes doubled; backslashes doubled behind E."""
    col = _col(c)
    body = F.replace(F.replace(col, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("''"))
    prefix = F.when(col.contains("\\"), F.lit("E")).otherwise(F.lit(""))
    return F.when(col.isNull(), F.lit("NULL")).otherwise(F.concat(prefix, F.lit("'"), body, F.lit("'")))


def _trunc_shift(v: Column, bits: int) -> Column:
    """``v / 2**bits`` truncated toward zero (repeated truncating divisions compose, so every
    unit step is taken from the original value and the expression stays flat)."""
    mag = F.shiftright(F.abs(v), bits)
    return F.when(v < 0, -mag).otherwise(mag)


def _half_rounded(x: Column) -> Column:
    """Halve, rounding half away from zero."""
    return F.when(x < 0, -F.shiftright(-x + 1, 1)).otherwise(F.shiftright(x + 1, 1))


def pg_size_pretty(c) -> Column:
    """Human-readable byte count, as PostgreSQL prints it (``4915200`` -> ``4800 kB``)."""
    v = _col(c).cast("long")
    # value in half-units of kB, MB, GB, TB, PB: divide by 2**9, then by 2**10 per unit
    halves = [_trunc_shift(v, 9 + 10 * i) for i in range(len(SIZE_UNITS))]
    out = F.when(F.abs(v) < SIZE_BYTES_LIMIT, F.concat(v.cast("string"), F.lit(" bytes")))
    for unit, half in zip(SIZE_UNITS[:-1], halves[:-1]):
        out = out.when(F.abs(half) < SIZE_HALF_UNIT_LIMIT,
                       F.concat(_half_rounded(half).cast("string"), F.lit(f" {unit}")))
    return F.when(v.isNull(), F.lit(None).cast("string")).otherwise(
        out.otherwise(F.concat(_half_rounded(halves[-1]).cast("string"), F.lit(f" {SIZE_UNITS[-1]}"))))

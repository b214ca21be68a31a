"""Access-control entries (``grantee=letters/grantor``) as columns.

An empty grantee means PUBLIC; a ``*`` after a letter marks a grant option and is
ignored, as are letters without a privilege word for the object kind.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Privilege letters and the words they print as, in the fixed output order.
RELATION_PRIVILEGES = (
    ("a", "INSERT"), ("r", "SELECT"), ("w", "UPDATE"), ("d", "DELETE"),
    ("D", "TRUNCATE"), ("x", "REFERENCES"), ("t", "TRIGGER"),
)
FUNCTION_PRIVILEGES = (("X", "EXECUTE"),)
SCHEMA_PRIVILEGES = (("U", "USAGE"), ("C", "CREATE"))
DEFAULT_PRIVILEGES = RELATION_PRIVILEGES + FUNCTION_PRIVILEGES + SCHEMA_PRIVILEGES

# Relation kinds that get a GRANT, and their object words.
RELATION_KINDS = (("r", "TABLE"), ("S", "SEQUENCE"), ("v", "VIEW"))
# Default-ACL object types and their plural words (corrected mode only).
DEFAULT_OBJTYPES = (("r", "TABLES"), ("S", "SEQUENCES"), ("f", "FUNCTIONS"), ("T", "TYPES"),
                    ("n", "SCHEMAS"))


def parse_entry(entry: Column) -> dict[str, Column]:
    """Split one entry into grantee, letters and grantor.

    ``usable`` is false when the entry has no ``/grantor`` part; such entries are skipped.
    """
    parts = F.split(entry, "=")
    grantee_raw = F.get(parts, 0)
    rest = F.split(F.get(parts, 1), "/")
    return {
        "acl_grantee": F.when(grantee_raw == "", F.lit("PUBLIC")).otherwise(grantee_raw),
        "letters": F.get(rest, 0),
        "acl_grantor": F.get(rest, 1),
        "usable": F.coalesce(F.size(rest) >= 2, F.lit(False)),
    }


def privilege_list(letters: Column, table=RELATION_PRIVILEGES) -> Column:
    """Comma-separated privilege words for the letters present, in the table's order.
    ``concat_ws`` skips the NULLs of absent letters, so no letter gives ``''``."""
    return F.concat_ws(", ", *[F.when(letters.contains(ch), F.lit(word)) for ch, word in table])


def kind_word(code: Column, table) -> Column:
    """Map a one-letter code to its word; unmapped codes give NULL."""
    out = None
    for ch, word in table:
        out = F.when(code == ch, F.lit(word)) if out is None else out.when(code == ch, F.lit(word))
    return out

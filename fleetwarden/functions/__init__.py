"""Column-expression helpers. Every helper returns a pyspark Column built from
built-in functions only, so it stays inside whole-stage code generation."""

from fleetwarden.functions.flags import (BIT_LOG_REPORTS, BIT_MAINTENANCE, BIT_REINDEX, flag_bits,
                                         flag_is_set, flag_update)
from fleetwarden.functions.pgtext import pg_size_pretty, quote_ident, quote_literal

__all__ = [
    "BIT_REINDEX", "BIT_MAINTENANCE", "BIT_LOG_REPORTS", "flag_is_set", "flag_update", "flag_bits",
    "quote_ident", "quote_literal", "pg_size_pretty",
]

"""DataFrame -> DataFrame operators."""

from fleetwarden.operators import bloat, catalog, fleet, grants, ledger, slicing

__all__ = ["fleet", "catalog", "bloat", "ledger", "slicing", "grants"]

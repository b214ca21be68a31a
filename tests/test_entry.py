"""The driver contract: entry() smoke-runs, queries() and oracle_sql() cover the same keys."""

import importlib.util
import os

ENTRY = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")


def _module():
    spec = importlib.util.spec_from_file_location("spark_entry", ENTRY)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_contract(spark):
    mod = _module()
    df = mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "bloat_ratio_percent" in df.columns
    from fleetwarden.plans.registry import QUERIES
    assert set(QUERIES) <= set(mod.queries()) and set(QUERIES) <= set(mod.oracle_sql()) <= set(mod.queries())
    assert all(callable(f) for f in mod.queries().values())

"""Execute every registered query and audit its final physical plan: no Cartesian
product, no nested-loop join, no Python evaluation; count shuffles and broadcasts.

    python tools/plan_audit.py [sf_dir]
"""

from __future__ import annotations

import collections
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")
COUNTED = ("SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "Exchange hashpartitioning",
           "Exchange rangepartitioning", "Exchange SinglePartition", "HashAggregate", "Generate", "Scan parquet")


def audit(df) -> tuple[list[str], dict[str, int]]:
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    bad = [f for f in FORBIDDEN if f in plan]
    counts = collections.Counter(re.findall("|".join(COUNTED), plan))
    return bad, dict(counts)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from fleetwarden.plans.registry import QUERIES
    from fleetwarden.session import build_session
    spark = build_session(cpus=8)
    worst = 0
    for name, fn in QUERIES.items():
        bad, counts = audit(fn(spark, sf_dir))
        worst += bool(bad)
        print(f"{'BAD' if bad else 'ok '} {name:26s} {bad or ''} {counts}")
    print(f"plans with forbidden operators: {worst}")


if __name__ == "__main__":
    main()

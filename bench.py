"""Bench: headline queries at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``. The stand-in catalog snapshots, which read ``part`` and ``lineitem``,
are written first and timed on their own (``snapshot_build``): catalog queries then read the
snapshots, not the driver's tables. The hub's ledger tables, which the cascade queries delete
from, are written by the first of them: in its cold time, not in its warm one. Each query runs once cold and then warm
``$BENCH_REPEAT`` times; the reported time per query is the warm median. Intermediate
folders are deleted after each query.
Every run executes the full plan into the ``noop`` sink (nothing is collected).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "fleet_targets", "enrolment_rows", "cascade_delete", "cascade_graph",
    "bloat_report", "bloat_search", "bloat_before_after",
    "run_ledger_fold", "run_ledger_fold_skip", "run_error_rows", "run_error_rows_skip", "ledger_compacted",
    "slice_tasks", "slice_rows", "slice_named_file", "slice_report", "slice_results", "slice_ledger_fold", "slice_windows", "slice_stream",
    "slice_stream_ledger",
    "grant_report", "event_log_append",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    from fleetwarden.plans.registry import QUERIES
    from fleetwarden.plans.standins import catalog_snapshot
    from fleetwarden.session import build_session, clear_scratch
    spark = build_session("fleetwarden-bench", cpus=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)))
    times, cold, errors = {}, {}, {}
    t = time.perf_counter()
    for variant in ("before", "after"):
        catalog_snapshot(spark, sf_dir, variant)
    snapshot = round(time.perf_counter() - t, 3)
    for name in HEADLINE:
        runs = []
        try:
            for i in range(repeat + 1):
                t = time.perf_counter()
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - t)
        except Exception as e:  # record and go on: one failing query must not lose the others
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
            continue
        finally:
            clear_scratch(spark, keep=("catalog-",))
        cold[name] = round(runs[0], 3)
        times[name] = round(statistics.median(runs[1:] or runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum of warm median seconds over headline queries",
                      "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "cold": cold, "snapshot_build": snapshot, "sf": sf, "cpus": int(cpus), "repeat": repeat,
                      **({"errors": errors} if errors else {})}))


if __name__ == "__main__":
    main()

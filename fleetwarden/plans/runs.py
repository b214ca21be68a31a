"""Composite runs: the daily index run, the two-hourly slice run and the grant listing,
each one Spark plan over the whole fleet (the hub's per-server / per-database loops
become joins and aggregates)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwarden.functions.flags import BIT_LOG_REPORTS, BIT_REINDEX
from fleetwarden.operators import bloat, fleet, ledger, slicing
from fleetwarden.session import stored
from fleetwarden.sources.catalog import Snapshot


ACTION_KEYS = ["db_id", "schema_name", "table_name", "index_name"]


def index_outcomes(compared: DataFrame, targets: DataFrame, connect_failed: DataFrame | None = None,
                   actions: DataFrame | None = None) -> DataFrame:
    """Outcome rows for the run ledger from the before/after comparison of the target
    databases. ``actions`` holds the results of the maintenance actions (``db_id,
    schema_name, table_name, index_name, ok, seconds, err_message, err_detail, err_code``, as
    reported by whatever ran them); a missing row, or no table, means success in 0 s.
    ``connect_failed`` (``db_id, err_message, err_code``) lists databases that could not be
    reached."""
    t = targets.select("server_id", "db_id")
    c = compared.join(t, "db_id")
    if actions is None:
        c = c.withColumns({"_ok": F.lit(True), "_secs": F.lit(0), **{k: F.lit(None) for k in ("_msg", "_det", "_code")}})
    else:
        c = c.join(actions.select(*ACTION_KEYS, F.col("ok").alias("_ok"), F.col("seconds").alias("_secs"),
                                  F.col("err_message").alias("_msg"), F.col("err_detail").alias("_det"),
                                  F.col("err_code").alias("_code")), ACTION_KEYS, "left")
    bad = ~F.coalesce(F.col("_ok"), F.lit(True))
    secs = F.coalesce(F.col("_secs"), F.lit(0))
    msg, det, code = F.when(bad, F.col("_msg")), F.when(bad, F.col("_det")), F.when(bad, F.col("_code"))
    idx = c.select(
        "server_id", "db_id", (~bad).alias("ok"), "schema_name", "table_name", "index_name",
        "bloat_before", "bloat_after", secs.cast("long").alias("seconds"),
        msg.cast("string").alias("err_message"), det.cast("string").alias("err_detail"),
        code.cast("string").alias("err_code"))
    if connect_failed is None:
        return idx
    conn = connect_failed.join(t, "db_id").select(
        "server_id", "db_id", F.lit(False).alias("ok"), F.lit(None).cast("string").alias("schema_name"),
        F.lit(None).cast("string").alias("table_name"), F.lit(None).cast("string").alias("index_name"),
        F.lit(None).cast("double").alias("bloat_before"), F.lit(None).cast("double").alias("bloat_after"),
        F.lit(None).cast("long").alias("seconds"), "err_message", F.lit(None).cast("string").alias("err_detail"),
        "err_code")
    return idx.unionByName(conn)


def reindex_run(servers: DataFrame, databases: DataFrame, before: Snapshot, after: Snapshot, run_ts,
                threshold: float = bloat.DEFAULT_THRESHOLD, on_error: str = "stop_run",
                connect_failed: DataFrame | None = None, actions: DataFrame | None = None) -> dict[str, DataFrame]:
    """Targets -> ledger rows -> bloat search on the before snapshot -> re-lookup on the
    after snapshot -> folded ledger and error rows.

    The before snapshot is estimated only for the target databases. The worklist is computed
    once and stored: the outcomes and whoever performs the maintenance read it, and the after
    snapshot is estimated only for databases on it. The outcomes are stored for the abort
    point, the fold and the error rows.
    """
    targets = fleet.fleet_targets(servers, databases, BIT_REINDEX)
    runs = ledger.open_runs(targets, run_ts)
    covered = before.with_(pg_index=before.pg_index.join(targets.select("db_id"), "db_id", "left_semi"))
    search = stored(bloat.bloat_search(bloat.bloat_report(covered, ordered=False), threshold, ordered=False), "worklist")
    looked_up = after.with_(pg_index=after.pg_index.join(search.select("db_id").distinct(), "db_id", "left_semi"))
    compared = bloat.compare_bloat(search, bloat.bloat_report(looked_up, ordered=False))
    outcomes = stored(index_outcomes(compared, targets, connect_failed, actions), "outcomes")
    split = ledger.reached(outcomes, runs, on_error)
    return {"targets": targets, "worklist": search, "outcomes": outcomes,
            "ledger": ledger.fold_runs(runs, outcomes, on_error, split),
            "errors": ledger.run_errors(runs, outcomes, on_error, split)}


def slice_run(servers: DataFrame, ini: DataFrame, runs, logs: DataFrame, files: DataFrame,
              strip_domain: str | None = None, call_outcomes: DataFrame | None = None,
              scheme: str = "slicer", write=None, read: str = slicing.ALL_LINES, keep: bool = False) -> dict[str, DataFrame]:
    """Tasks -> slices -> listing -> replies -> routing -> folded slice ledger.

    The task list (servers x config rows x runs) feeds every step, so it is stored: joins
    then plan with its true size. ``call_outcomes`` holds what became of each remote call
    (see ``slicing.reached_tasks``) and ``scheme`` labels failures on the hub's side.
    ``write`` takes the slice rows and returns them as written; the logs are then read once,
    for the slices, and the ledger aggregates those. ``read`` says whether a slice is cut
    from the file that its run names or from all of its server's lines. ``keep``: see
    ``settle_tasks``.
    """
    tasks = slicing.slice_tasks(servers, ini, runs, BIT_LOG_REPORTS, strip_domain)
    called = stored(slicing.reached_tasks(tasks, call_outcomes), "tasks")
    made = slicing.calls_made(called)
    bounds = slicing.time_bounds(made)
    slices = write(slicing.slice_rows(logs, made, bounds, read)) if write else None
    report = slicing.slice_report(logs, made, bounds, slices, read)
    listing = slicing.log_listing(files, tasks=made)
    return {"tasks": called.drop("stage", "err_message", "err_detail", "err_code", "seconds"), "report": report, "listing": listing,
            **settle_tasks(called, report, listing, call_outcomes is not None, scheme, keep)}


def settle_tasks(called: DataFrame, report: DataFrame, listing: DataFrame, calls_can_fail: bool = False,
                 scheme: str = "slicer", keep: bool = False) -> dict[str, DataFrame]:
    """What follows from the report of the tasks ``called`` (see ``slicing.reached_tasks``):
    results, JSON replies, their routing, error rows and the folded slice ledger. ``keep``
    stores the replies, for callers that take several of these: the logs are then cut once."""
    stage = F.coalesce(F.col("stage"), F.lit(""))
    results = slicing.slice_results(report, listing, called)
    replies = slicing.envelope_json(results)
    replies = stored(replies, "replies") if keep else replies
    routed = slicing.route(slicing.read_replies(replies))
    opened = slicing.open_slices(called.filter(stage != slicing.DISCONNECT))
    updated = routed["updates"].join(called.filter(stage == slicing.UPDATE).select(*slicing.TASK_KEY), slicing.TASK_KEY, "left_anti")
    errors = routed["errors"]
    if calls_can_fail:
        errors = errors.unionByName(slicing.hub_failures(called, routed["updates"], scheme))
    return {"results": results, "replies": replies, "errors": ledger.error_rows(errors, "slicer"), "unrouted": routed["unrouted"],
            "ledger": slicing.fold_slices(opened, updated)}

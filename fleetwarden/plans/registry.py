"""Query registry: one callable ``(spark, sf_dir) -> DataFrame`` per operator, each over the
whole stand-in inputs of that scale factor. ``plans/oracle.py`` holds the DuckDB twin."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwarden.functions.flags import BIT_LOG_REPORTS, BIT_MAINTENANCE, BIT_REINDEX, flag_update
from fleetwarden.operators import bloat, catalog, fleet, grants, ledger, slicing
from fleetwarden.plans import runs as R
from fleetwarden.plans import standins as S
from fleetwarden.plans.views import index_run_script, register_functions
from fleetwarden.session import ensure_utc, scratch_path, small_broadcasts, stored, together
from fleetwarden.sources.compaction import append_batch, compact, compacted_state
from fleetwarden.sources.identity import append_identified, identified
from fleetwarden.sources.loglisting import LogListing, write_log_folders
from fleetwarden.sources.sinks import append_ledger, current_state
from fleetwarden.sources.tables import read_table
from fleetwarden.streaming import slices as stream_slices
from fleetwarden.streaming.commits import committed
from fleetwarden.streaming.eventlog import append_events_once, append_events_stream
from fleetwarden.streaming.slicer import SliceLedgerStream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    def wrapped(spark: SparkSession, d: str) -> DataFrame:
        ensure_utc(spark)
        return fn(spark, d)
    wrapped.__name__ = fn.__name__
    wrapped.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = wrapped
    return wrapped


# ------------------------------------------------------------------ fleet
@query
def fleet_flag_filter(spark, d):
    return fleet.with_flag(S.databases(spark, d), "switch_db", BIT_REINDEX).select(
        "pk_id_db", "fk_pk_id_conn", "db_name", "switch_db")


@query
def fleet_flag_update(spark, d):
    db = S.databases(spark, d)
    return db.select("pk_id_db", "switch_db",
                     flag_update("switch_db", BIT_LOG_REPORTS, "set", F.col("pk_id_db") % 5 == 0).alias("set_32"),
                     flag_update("switch_db", BIT_REINDEX, "clear", F.col("db_scheme") == "Public").alias("clear_128"),
                     flag_update("switch_db", 1, "toggle").alias("toggle_1"))


@query
def fleet_flag_decode(spark, d):
    return fleet.decode_flags(S.servers(spark, d), "switch_serv").select(
        "pk_id_conn", "switch_serv", "switch_serv_bits", "reindex", "maintenance", "log_reports")


@query
def fleet_flag_counts(spark, d):
    return fleet.flag_counts(S.databases(spark, d), "switch_db", ["db_scheme"])


@query
def fleet_targets(spark, d):
    return fleet.fleet_targets(S.servers(spark, d), S.databases(spark, d), BIT_REINDEX)


@query
def enrolment_rows(spark, d):
    return fleet.enrolment_rows(S.pg_database(spark, d))


@query
def fk_orphans(spark, d):
    return fleet.orphans(S.databases(spark, d), S.servers(spark, d), "fk_pk_id_conn", "pk_id_conn").select(
        "pk_id_db", "fk_pk_id_conn", "db_name")


_LEDGERS: dict[tuple, dict[str, str]] = {}


def _hub_ledgers(spark, d):
    """The hub's ledger tables after one index run and one slice run, written once per session."""
    key = (spark.sparkContext.applicationId, os.path.abspath(d))
    if key not in _LEDGERS:
        with small_broadcasts(spark):
            run, cut = together(spark, lambda: _reindex_run(spark, d, "skip_database"), lambda: _slice(spark, d, keep=True))
            rows = {"run_ledger": run["ledger"], "run_errors": run["errors"], "slice_ledger": cut["ledger"], "slice_errors": cut["errors"]}
            paths = {name: scratch_path(spark, f"catalog-{name}") for name in rows}
            together(spark, *[lambda name=name, df=df: df.write.parquet(paths[name]) for name, df in rows.items()])
        _LEDGERS[key] = paths
    return {name: spark.read.parquet(path) for name, path in _LEDGERS[key].items()}


@query
def cascade_delete(spark, d):
    sv, db = S.servers(spark, d), S.databases(spark, d)
    doomed = fleet.with_flag(sv, "switch_serv", BIT_MAINTENANCE)
    hub = _hub_ledgers(spark, d)
    res = fleet.cascade_delete(sv, db, doomed, ini=S.pg_ini(spark, d), runs=hub["run_ledger"], run_errors=hub["run_errors"],
                               slices=hub["slice_ledger"], slice_errors=hub["slice_errors"])
    with small_broadcasts(spark):
        return stored(fleet.cascade_summary(res), "cascade-summary")


@query
def cascade_graph(spark, d):
    """The same deletion, along the foreign keys as a table."""
    tables = {"servers": S.servers(spark, d), "databases": S.databases(spark, d), "pg_ini": S.pg_ini(spark, d), **_hub_ledgers(spark, d)}
    doomed = fleet.with_flag(tables["servers"], "switch_serv", BIT_MAINTENANCE).select("pk_id_conn")
    constraints = spark.createDataFrame(fleet.FOREIGN_KEYS, fleet.CONSTRAINT)
    with small_broadcasts(spark):
        return stored(fleet.cascade_summary(fleet.cascade_graph(tables, constraints, "servers", doomed)), "cascade-summary")


# ------------------------------------------------------------------ catalog + bloat
@query
def overridden_tables(spark, d):
    return catalog.overridden_tables(S.catalog_snapshot(spark, d))


@query
def index_columns(spark, d):
    return catalog.index_columns(S.catalog_snapshot(spark, d))


@query
def index_stats(spark, d):
    return catalog.index_stats(S.catalog_snapshot(spark, d))


@query
def index_widths(spark, d):
    return bloat.index_widths(S.catalog_snapshot(spark, d))


@query
def aligned_widths(spark, d):
    return bloat.aligned_widths(bloat.index_widths(S.catalog_snapshot(spark, d)))


@query
def page_estimates(spark, d):
    return bloat.page_estimates(bloat.aligned_widths(bloat.index_widths(S.catalog_snapshot(spark, d))))


@query
def bloat_measures(spark, d):
    return bloat.bloat_measures(bloat.page_estimates(bloat.aligned_widths(
        bloat.index_widths(S.catalog_snapshot(spark, d)))))


@query
def bloat_report(spark, d):
    return bloat.bloat_report(S.catalog_snapshot(spark, d))


@query
def bloat_report_corrected(spark, d):
    return bloat.bloat_report(S.catalog_snapshot(spark, d), fanout="corrected")


@query
def bloat_search(spark, d):
    return bloat.bloat_search(bloat.bloat_report(S.catalog_snapshot(spark, d), ordered=False), S.THRESHOLD)


@query
def sql_bloat_function(spark, d):
    """The report through the SQL table function alone."""
    register_functions(spark, S.catalog_snapshot(spark, d))
    return spark.sql("SELECT * FROM get_bloated_indexes(how => 'corrected')")


@query
def sql_index_run(spark, d):
    """The index run's search as a SQL script over the table functions."""
    targets = fleet.fleet_targets(S.servers(spark, d), S.run_databases(spark, d), BIT_REINDEX)
    return index_run_script(spark, S.catalog_snapshot(spark, d), targets, S.THRESHOLD)


@query
def bloat_before_after(spark, d):
    before = bloat.bloat_search(bloat.bloat_report(S.catalog_snapshot(spark, d), ordered=False), S.THRESHOLD,
                                ordered=False)
    return bloat.compare_bloat(before, bloat.bloat_report(S.catalog_snapshot(spark, d, "after"), ordered=False))


# ------------------------------------------------------------------ ledgers
def _reindex(spark, d, on_error):
    with small_broadcasts(spark):
        return _reindex_run(spark, d, on_error)


def _reindex_run(spark, d, on_error):
    before, after = S.catalog_snapshots(spark, d)
    return R.reindex_run(S.servers(spark, d), S.run_databases(spark, d), before, after, S.RUN_TS, S.THRESHOLD, on_error,
                         connect_failed=S.connect_failed(spark, d), actions=S.actions(spark, d))


@query
def run_ledger_open(spark, d):
    return ledger.open_runs(fleet.fleet_targets(S.servers(spark, d), S.databases(spark, d), BIT_REINDEX), S.RUN_TS)


@query
def run_ledger_fold(spark, d):
    return _reindex(spark, d, "stop_run")["ledger"]


@query
def run_ledger_fold_skip(spark, d):
    return _reindex(spark, d, "skip_database")["ledger"]


@query
def run_error_rows(spark, d):
    return _reindex(spark, d, "stop_run")["errors"]


@query
def run_error_rows_skip(spark, d):
    return _reindex(spark, d, "skip_database")["errors"]


@query
def error_rows(spark, d):
    return ledger.error_rows(S.error_events(spark, d), "slicer")


@query
def event_log_append(spark, d):
    return ledger.append_events(S.events_in(spark, d), S.EVENT_NOW, S.EVENT_USER)


@query
def event_log_stream(spark, d):
    """The event log appended by a stream over ``events.parquet`` (available-now trigger)."""
    schema = read_table(spark, d, "events").schema
    raw = (spark.readStream.format("parquet").schema(schema).option("pathGlobFilter", "events.parquet").load(d))
    sink, ckpt = scratch_path(spark, "event-log"), scratch_path(spark, "event-log-ckpt")
    append_events_stream(S.events_of(raw), sink, ckpt, S.EVENT_USER, now=S.EVENT_NOW).awaitTermination()
    return spark.read.parquet(sink).drop("batch")


@query
def event_log_once(spark, d):
    """The event log of a stream whose files were delivered twice."""
    twice, out = scratch_path(spark, "events-twice"), scratch_path(spark, "event-log-once")
    raw = read_table(spark, d, "events")
    for _ in range(2):
        raw.write.mode("append").parquet(twice)
    # as many batches however many files there are: each one goes through the whole state
    files = max(1, len(spark.read.schema(raw.schema).parquet(twice).inputFiles()) // 4)
    rows = S.events_of(spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", files).parquet(twice))
    append_events_once(rows, out, scratch_path(spark, "event-log-once-ckpt"), S.EVENT_USER, within="3650 days", now=S.EVENT_NOW).awaitTermination()
    return committed(spark, out, "events", ledger.append_events(S.events_in(spark, d), S.EVENT_NOW, S.EVENT_USER).schema)


# ------------------------------------------------------------------ slicing
def _runs_as_events(spark, d):
    return read_table(spark, d, "events", ["event_id", "ts"]).withColumnRenamed("ts", "run_ts")


def _tasks(spark, d):
    return slicing.slice_tasks(S.servers(spark, d), S.pg_ini(spark, d), S.slice_runs(spark, d), BIT_LOG_REPORTS,
                               S.HOST_DOMAIN)


def _stored_tasks(spark, d):
    tasks = stored(_tasks(spark, d), "tasks")
    return tasks, slicing.time_bounds(tasks)


def _slice(spark, d, outcomes=False, keep=False):
    return R.slice_run(S.servers(spark, d), S.pg_ini(spark, d), S.slice_runs(spark, d), S.logs(spark, d),
                       S.log_files(spark, d), S.HOST_DOMAIN, S.call_outcomes(spark, d) if outcomes else None, keep=keep)


@query
def slice_window(spark, d):
    return slicing.slice_window(_runs_as_events(spark, d)).select(
        "event_id", "run_ts", "log_day", "log_name", "window_start", "window_end", "end_inclusive",
        "window_crosses_file")


@query
def log_name(spark, d):
    return slicing.log_name(_runs_as_events(spark, d)).select("event_id", "run_ts", "log_day", "log_name")


@query
def slice_tasks(spark, d):
    return _tasks(spark, d)


@query
def log_listing(spark, d):
    return slicing.log_listing(S.log_files(spark, d), tasks=_stored_tasks(spark, d)[0])


@query
def slice_rows(spark, d):
    return slicing.slice_rows(S.logs(spark, d), *_stored_tasks(spark, d))


@query
def slice_report(spark, d):
    return slicing.slice_report(S.logs(spark, d), *_stored_tasks(spark, d))


@query
def slice_named_file(spark, d):
    """Slice lines, each slice cut from the log file that its run names (logs in day folders)."""
    return slicing.slice_rows(S.logs_by_day(spark, d), *_stored_tasks(spark, d), read=slicing.NAMED_FILE)


@query
def slice_named_ledger(spark, d):
    """The slice ledger of a run over named files."""
    return R.slice_run(S.servers(spark, d), S.pg_ini(spark, d), S.slice_runs(spark, d), S.logs_by_day(spark, d), S.log_files(spark, d),
                       S.HOST_DOMAIN, read=slicing.NAMED_FILE)["ledger"]


@query
def slice_results(spark, d):
    return _slice(spark, d)["results"]


@query
def slice_route(spark, d):
    return slicing.route_label(slicing.read_replies(_slice(spark, d)["replies"])).select(
        "server_id", "run_ts", "route", F.when(F.col("route") == "error", F.col("status_text"))
        .when(F.col("route") == "update", F.lit(slicing.STATUS_READY)).otherwise(F.col("status_text"))
        .alias("status_text"))


@query
def slice_error_rows(spark, d):
    return _slice(spark, d)["errors"]


@query
def slice_ledger_fold(spark, d):
    return _slice(spark, d)["ledger"]


@query
def slice_reply_json(spark, d):
    return _slice(spark, d)["replies"].select(*slicing.TASK_KEY, "reply")


@query
def slice_departures(spark, d):
    """The argument objects of the remote calls (VARIANT), as JSON text."""
    return slicing.departures(_tasks(spark, d)).select(*slicing.TASK_KEY, F.to_json("departure").alias("departure"))


@query
def reply_variant(spark, d):
    """Replies that carry more or fewer fields than the hub's, or numbers as text, routed."""
    kind, reply = F.col("pk_id_pgini") % 4, F.col("reply")
    shaped = (F.when(kind == 0, F.regexp_replace(reply, r'("full_log_size":)(\d+)', '$1"$2"'))
              .when(kind == 1, F.regexp_replace(reply, r"^\{", '{"host":{"os":"linux","cpus":[1,2]},"status_text":"init",'))
              .when(kind == 2, F.regexp_replace(reply, r'"full_log_name":"[^"]*",', ""))
              .otherwise(reply))
    read = slicing.read_variant_replies(_slice(spark, d)["replies"].withColumn("reply", shaped))
    return slicing.route_label(read).join(read.select(*slicing.TASK_KEY, "full_log_name", "full_log_size", "full_log_modf", "slice_file_size", "sqlstate"),
                                          slicing.TASK_KEY)


@query
def log_listing_source(spark, d):
    """Files and bytes per server, by the listing source over written log folders."""
    path = scratch_path(spark, "log-folders")
    write_log_folders(S.logs(spark, d), path)
    spark.dataSource.register(LogListing)
    return (spark.read.format("log_listing").load(path).where(F.col("name").endswith(".txt")).groupBy("server_id")
            .agg(F.count("*").alias("n_files"), F.sum("size").alias("bytes")))


@query
def slice_results_large(spark, d):
    """Replies over slices as large as the order lines make them; some exceed 2 GiB."""
    tasks, bounds = _stored_tasks(spark, d)
    report = slicing.slice_report(S.logs(spark, d), tasks, bounds)
    factor = read_table(spark, d, "lineitem", ["l_quantity"]).select((F.sum("l_quantity") * 4).cast("long")).scalar()
    return slicing.slice_results(report.withColumn("slice_bytes", F.col("slice_bytes") * factor),
                                 slicing.log_listing(S.log_files(spark, d), tasks=tasks))


@query
def slice_run_errors(spark, d):
    return _slice(spark, d, True)["errors"]


@query
def slice_run_ledger(spark, d):
    return _slice(spark, d, True)["ledger"]


@query
def slice_errors_current(spark, d):
    """The slicer's error table after a batch that was written twice."""
    path, rows = scratch_path(spark, "slice-errors"), stored(_slice(spark, d)["errors"], "errors")
    for _ in range(2):
        append_ledger(rows, path, "slice_errors", S.EVENT_NOW)
    return current_state(spark, path, "slice_errors").drop("pk")


@query
def ledger_compacted(spark, d):
    """The run ledger opened in one batch, compacted, and folded in the next batch, which was
    written twice."""
    path, fold = scratch_path(spark, "run-ledger"), stored(_reindex(spark, d, "skip_database")["ledger"], "fold")
    opened = ledger.open_runs(fleet.fleet_targets(S.servers(spark, d), S.run_databases(spark, d), BIT_REINDEX), S.RUN_TS)
    append_batch(opened, path, "run_ledger", "open", S.RUN_TS)
    compact(spark, path, "run_ledger")
    for _ in range(2):
        append_batch(fold, path, "run_ledger", "fold", S.EVENT_NOW)
    return compacted_state(spark, path, "run_ledger").drop("pk")


@query
def ledger_identity(spark, d):
    """The slicer's error table with its identity column: three batches, the second of which
    came twice."""
    path, rows = scratch_path(spark, "slice-errors-identity"), ledger.error_rows(S.error_events(spark, d), "slicer")
    for part in (0, 1, 1, 2):
        got = append_identified(rows.where((F.dayofmonth("slice_now_ins") - 1) % 3 == part), path, str(part), "pk_id_slice_err")
    return identified(spark, path, got.schema)


@query
def ledger_current_state(spark, d):
    """The run ledger, opened in one batch and folded in the next, which was written twice."""
    path, fold = scratch_path(spark, "run-ledger"), stored(_reindex(spark, d, "skip_database")["ledger"], "fold")
    append_ledger(ledger.open_runs(fleet.fleet_targets(S.servers(spark, d), S.run_databases(spark, d), BIT_REINDEX), S.RUN_TS),
                  path, "run_ledger", S.RUN_TS)
    for _ in range(2):
        append_ledger(fold, path, "run_ledger", S.EVENT_NOW)
    return current_state(spark, path, "run_ledger").drop("pk")


# ------------------------------------------------------------------ grants
@query
def relation_grants(spark, d):
    return grants.relation_grants(S.grants_snapshot(spark, d), S.GRANTOR, S.GRANTEE)


@query
def function_grants(spark, d):
    return grants.function_grants(S.grants_snapshot(spark, d), S.GRANTOR, S.GRANTEE)


@query
def schema_grants(spark, d):
    return grants.schema_grants(S.grants_snapshot(spark, d), S.GRANTOR, S.GRANTEE)


@query
def default_grants(spark, d):
    return grants.default_grants(S.grants_snapshot(spark, d), S.GRANTOR, S.GRANTEE)


@query
def grant_report(spark, d):
    return grants.grant_report(S.grants_snapshot(spark, d), S.GRANTOR, S.GRANTEE)


@query
def grant_report_corrected(spark, d):
    return grants.grant_report(S.grants_snapshot(spark, d), S.GRANTOR, S.GRANTEE, mode="corrected")


# ------------------------------------------------------------------ continuous slicing
@query
def slice_windows(spark, d):
    return stream_slices.slice_windows(S.logs(spark, d))


@query
def slice_stream(spark, d):
    """Streams ``events.parquet`` through the watermarked two-hour slicer into a parquet
    sink (available-now trigger) and returns the emitted (closed) windows."""
    schema = read_table(spark, d, "events").schema
    ev = (spark.readStream.format("parquet").schema(schema).option("pathGlobFilter", "events.parquet")
          .option("maxFilesPerTrigger", 1).load(d))
    lg = ev.select(F.col("user_id").cast("int").alias("server_id"), F.col("ts").alias("log_ts"),
                   F.concat(F.col("event_type"), F.lit(" "), F.col("props")).alias("line"))
    sink, ckpt = scratch_path(spark, "slice-stream-out"), scratch_path(spark, "slice-stream-ckpt")
    q = stream_slices.run_slice_stream(spark, lg, sink, ckpt)
    q.awaitTermination()
    return spark.read.schema(_stream_out_schema(spark, d)).parquet(sink)


@query
def slice_stream_ledger(spark, d):
    """The whole two-hour run as a stream over ``events.parquet``: the ledger rows of the
    windows that its watermark closed."""
    schema = read_table(spark, d, "events").schema
    ev = spark.readStream.format("parquet").schema(schema).option("pathGlobFilter", "events.parquet").load(d)
    out = scratch_path(spark, "slice-ledger-stream")
    inputs = {"servers": S.servers(spark, d), "ini": S.pg_ini(spark, d), "schedule": S.slice_runs(spark, d),
              "files": S.log_files(spark, d), "call_outcomes": S.call_outcomes(spark, d)}
    stream = SliceLedgerStream(spark, lambda: inputs, out, strip_domain=S.HOST_DOMAIN)
    stream.start(S.logs_of(ev), scratch_path(spark, "slice-ledger-ckpt")).awaitTermination()
    return committed(spark, out, "ledger", _slice(spark, d, True)["ledger"].schema)


def _stream_out_schema(spark, d):
    return stream_slices.slice_windows(S.logs(spark, d)).schema

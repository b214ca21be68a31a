"""Scheduled jobs: the daily index run and the two-hourly slice run as Spark jobs that read
the hub tables and snapshots and append to the ledgers (what the hub's cron entries call).

    python -m fleetwarden.jobs index --hub DIR --before DIR --after DIR --run-ts TS --out DIR
    python -m fleetwarden.jobs slice --hub DIR --logs DIR --files DIR --runs DIR --out DIR
        [--log-format parquet|jsonlog|stderr] [--read named|window]
    python -m fleetwarden.jobs slice-stream --hub DIR --logs DIR --files DIR --runs DIR --out DIR [--every "10 minutes"]
    python -m fleetwarden.jobs compact --path DIR --ledger NAME

Hub tables are parquet folders under ``--hub``: ``servers``, ``databases``, ``pg_ini``
(and optionally ``actions`` / ``connect_failed`` for the index run, ``call_outcomes`` for
the slice run). Ledgers are appended under ``--out``: ``run_ledger``, ``run_errors``, ``slice_ledger``, ``slice_errors``, and
the worklist / slices are written beside them. With ``--store compacted`` they are written
for ``compact``, which folds what has come together (``sources.compaction``). The stream reads
jsonlog files as they appear and writes ledger, errors, replies and late lines batch by batch.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwarden.functions.timeexpr import as_ntz
from fleetwarden.operators import bloat, slicing
from fleetwarden.plans.runs import reindex_run, slice_run
from fleetwarden.session import apply_conf, ensure_utc, path_exists
from fleetwarden.sources.catalog import Snapshot
from fleetwarden.sources.compaction import append_batch, compact
from fleetwarden.sources.logdir import named_files, read_jsonlog, read_jsonlog_stream, read_stderr_log
from fleetwarden.sources.sinks import LEDGER_KEYS, append_ledger, write_slices
from fleetwarden.streaming.slicer import SliceLedgerStream

#: How a job keeps its ledgers: appended and folded by the reader, or for compaction.
APPENDED, COMPACTED = "appended", "compacted"


def _opt(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if path_exists(spark, path) else None


def index_job(spark: SparkSession, servers: DataFrame, databases: DataFrame, before: Snapshot, after: Snapshot,
              run_ts, out: str, threshold: float = bloat.DEFAULT_THRESHOLD, on_error: str = "stop_run",
              actions: DataFrame | None = None, connect_failed: DataFrame | None = None,
              store: str = APPENDED) -> dict[str, DataFrame]:
    """E1 over the whole fleet: appends the folded run ledger and its error rows, writes the
    worklist (indexes above the threshold) for whatever performs the maintenance."""
    ensure_utc(spark)
    res = reindex_run(servers, databases, before, after, run_ts, threshold, on_error,
                      connect_failed=connect_failed, actions=actions)
    res["worklist"].write.mode("overwrite").parquet(f"{out}/worklist")
    _append(res["ledger"], out, "run_ledger", run_ts, store)
    _append(res["errors"], out, "run_errors", run_ts, store)
    return res


def _append(rows: DataFrame, out: str, ledger: str, batch_ts, store: str) -> None:
    if store == COMPACTED:
        append_batch(rows, f"{out}/{ledger}", ledger, batch_name(batch_ts), batch_ts)
    else:
        append_ledger(rows, f"{out}/{ledger}", ledger, batch_ts)


def batch_name(batch_ts) -> str:
    return str(batch_ts).replace(" ", "T").replace(":", "")


def slice_job(spark: SparkSession, servers: DataFrame, ini: DataFrame, runs, logs: DataFrame, files: DataFrame,
              out: str, strip_domain: str | None = None, batch_ts=None, call_outcomes: DataFrame | None = None,
              scheme: str = "slicer", read: str | None = None, store: str = APPENDED) -> dict[str, DataFrame]:
    """E2 over the whole fleet: writes the slices of this batch beside those of the others,
    appends the slice ledger and error rows. The batch is named by ``batch_ts`` or else by
    the last run of its schedule, so that a retry replaces its own slices and no others and
    repeats its ledger rows instead of adding to them. ``read``: from the log file that each
    run names, as the hub does, or from all lines (see ``slicing.slice_rows``); where not
    given, from named files if the logs tell files apart (``log_day`` or ``log_name``)."""
    ensure_utc(spark)
    read = read or (slicing.NAMED_FILE if {"log_day", "log_name"} & set(logs.columns) else slicing.ALL_LINES)
    batch_ts = batch_ts or schedule_time(runs)

    def write(rows: DataFrame) -> DataFrame:
        folder = write_slices(rows, f"{out}/slices", batch_name(batch_ts))
        return spark.read.schema(rows.schema).parquet(folder)

    res = slice_run(servers, ini, runs, logs, files, strip_domain, call_outcomes, scheme, write, read)
    _append(res["ledger"], out, "slice_ledger", batch_ts, store)
    _append(res["errors"], out, "slice_errors", batch_ts, store)
    return res


def slice_stream_job(spark: SparkSession, hub: str, logs: str, files: str, runs: str, out: str, strip_domain: str | None = None,
                     scheme: str = "slicer", every: str | None = None) -> SliceLedgerStream:
    """E2 as a stream over jsonlog files: drains what is there, or runs on with a trigger
    ``every`` so often. The hub's tables are read anew for each micro-batch."""
    def inputs() -> dict[str, DataFrame]:
        given = {"servers": spark.read.parquet(f"{hub}/servers"), "ini": spark.read.parquet(f"{hub}/pg_ini"),
                 "schedule": spark.read.parquet(runs), "files": spark.read.parquet(files)}
        outcomes = _opt(spark, f"{hub}/call_outcomes")
        return given if outcomes is None else {**given, "call_outcomes": outcomes}
    stream = SliceLedgerStream(spark, inputs, out, strip_domain=strip_domain, scheme=scheme)
    stream.start(read_jsonlog_stream(spark, logs), f"{out}/checkpoint", every).awaitTermination()
    return stream


def schedule_time(runs) -> dt.datetime:
    """The last run time of a schedule (or the one run time); of an empty one, the epoch."""
    last = runs.agg(F.max(as_ntz(F.col("run_ts")))).first()[0] if isinstance(runs, DataFrame) else runs
    return last or dt.datetime(1970, 1, 1)


def read_logs(spark: SparkSession, path: str, fmt: str, runs: DataFrame, read: str | None) -> DataFrame:
    """The server logs under ``path``: parquet (in ``log_day`` folders or plain) or raw files
    by server. Of raw files only those that the schedule's runs name, unless all are asked for."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    names = named_files(slicing.log_name(runs.select(as_ntz(F.col("run_ts")).alias("run_ts")).distinct())) if read != slicing.ALL_LINES else None
    return {"jsonlog": read_jsonlog, "stderr": read_stderr_log}[fmt](spark, path, names)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="fleetwarden.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    a = sub.add_parser("index")
    a.add_argument("--hub", required=True)
    a.add_argument("--before", required=True)
    a.add_argument("--after", required=True)
    a.add_argument("--run-ts", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--threshold", type=float, default=bloat.DEFAULT_THRESHOLD)
    a.add_argument("--on-error", default="stop_run")
    c = sub.add_parser("slice-stream")
    for name in ("hub", "logs", "files", "runs", "out"):
        c.add_argument(f"--{name}", required=True)
    c.add_argument("--strip-domain", default=None)
    c.add_argument("--scheme", default="slicer")
    c.add_argument("--every", default=None)
    e = sub.add_parser("compact")
    e.add_argument("--path", required=True)
    e.add_argument("--ledger", required=True, choices=sorted(LEDGER_KEYS))
    b = sub.add_parser("slice")
    b.add_argument("--hub", required=True)
    b.add_argument("--logs", required=True)
    b.add_argument("--files", required=True)
    b.add_argument("--runs", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--strip-domain", default=None)
    b.add_argument("--batch-ts", default=None)
    b.add_argument("--scheme", default="slicer")
    b.add_argument("--log-format", choices=("parquet", "jsonlog", "stderr"), default="parquet")
    b.add_argument("--read", choices=(slicing.NAMED_FILE, slicing.ALL_LINES), default=None)
    for with_ledgers in (a, b):
        with_ledgers.add_argument("--store", choices=(APPENDED, COMPACTED), default=APPENDED)
    args = ap.parse_args(argv)
    spark = apply_conf(SparkSession.builder.appName(f"fleetwarden-{args.job}").getOrCreate())
    if args.job == "compact":
        compact(spark, args.path, args.ledger)
        return
    if args.job == "slice-stream":
        slice_stream_job(spark, args.hub, args.logs, args.files, args.runs, args.out, args.strip_domain, args.scheme, args.every)
        return
    hub = args.hub
    servers, databases = spark.read.parquet(f"{hub}/servers"), spark.read.parquet(f"{hub}/databases")
    if args.job == "index":
        index_job(spark, servers, databases, Snapshot.read(spark, args.before), Snapshot.read(spark, args.after),
                  args.run_ts, args.out, args.threshold, args.on_error, _opt(spark, f"{hub}/actions"),
                  _opt(spark, f"{hub}/connect_failed"), args.store)
    else:
        runs = spark.read.parquet(args.runs)
        slice_job(spark, servers, spark.read.parquet(f"{hub}/pg_ini"), runs, read_logs(spark, args.logs, args.log_format, runs, args.read),
                  spark.read.parquet(args.files), args.out, args.strip_domain, args.batch_ts, _opt(spark, f"{hub}/call_outcomes"),
                  args.scheme, args.read, args.store)


if __name__ == "__main__":
    main()

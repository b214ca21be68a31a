"""Append-only ledgers folded to their current state.

The hub updates ledger rows in place; here a run's rows are *opened* with defaults and
the outcomes are *folded* onto them by key, so no row-level update is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwarden.functions.timeexpr import as_ntz, epoch_seconds

# Run-ledger defaults and sentinels.
CLOCKING_NOT_SET = 11232000
BLOAT_BEFORE_DEFAULT = 0.0
BLOAT_AFTER_NOT_REACHED = -999.0
NO_INDEX = "NIHIL"
DET_DATE_OFFSET_SECONDS = 10800     # epoch of the UTC time re-read at offset '+03' (POSIX sign)
# Error-ledger blanks and labels.
REINDEX_ERROR_BLANK = "*"
SLICER_ERROR_BLANK = ";"
LABEL_CONNECT = "DBLINK_CONNECT"
LABEL_REINDEX = "DBLINK_CONNECT_REINDEX"
ON_ERROR_MODES = ("stop_run", "skip_database")


def run_key(db_id: Column, det_date: Column) -> Column:
    """Deterministic ledger key ``<db_id>@<det_date>`` (no global row numbering)."""
    return F.concat(db_id.cast("string"), F.lit("@"), det_date.cast("string"))


def open_runs(targets: DataFrame, run_ts) -> DataFrame:
    """One ledger row per target database, every value at its default."""
    det_date = epoch_seconds(as_ntz(run_ts)) + F.lit(DET_DATE_OFFSET_SECONDS)
    return targets.select(
        run_key(F.col("db_id"), det_date).alias("run_key"), "server_id",
        F.col("db_id").alias("fk_pk_id_db_j"), det_date.alias("det_date"),
        F.lit(CLOCKING_NOT_SET).cast("long").alias("det_clocking"),
        F.lit(BLOAT_BEFORE_DEFAULT).cast("float").alias("det_perc_bloat"),
        F.lit(BLOAT_AFTER_NOT_REACHED).cast("float").alias("det_perc_bloat_after"),
        F.lit(NO_INDEX).alias("det_table_name"), F.lit(NO_INDEX).alias("det_index_name"))


def _position(prefix: str = "") -> Column:
    """Processing order: servers, then databases, then indexes by ascending bloat (schema,
    table and name break ties); a connection failure (no index) sorts before the database's
    indexes."""
    return F.struct(F.col(f"{prefix}server_id").alias("s"), F.col(f"{prefix}db_id").alias("d"),
                    F.coalesce(F.col(f"{prefix}bloat_before"), F.lit(-1.0)).alias("r"),
                    *[F.coalesce(F.col(f"{prefix}{c}_name"), F.lit("")).alias(c) for c in ("schema", "table", "index")])


def reached(outcomes: DataFrame, runs: DataFrame, on_error: str = "stop_run"):
    """Split a run at its abort point: (runs that were opened, outcomes applied, failures written).

    ``stop_run``: one position for the whole run. It is a global aggregate, so exactly one
    row, which is broadcast to both sides; nothing is fetched while the plan is built.
    ``skip_database``: one position per database, a grouped min joined back by ``db_id``.
    """
    if on_error not in ON_ERROR_MODES:
        raise ValueError(f"on_error must be one of {ON_ERROR_MODES}")
    pos, abort = _position(), F.col("abort")
    failed = outcomes.filter(~F.col("ok"))
    if on_error == "stop_run":
        point = F.broadcast(failed.agg(F.min(pos).alias("abort")).withColumn("_all", F.lit(1)))
        o = outcomes.withColumn("_all", F.lit(1)).join(point, "_all").drop("_all")
        before = (F.col("server_id") < F.col("abort.s")) | (
            (F.col("server_id") == F.col("abort.s")) & (F.col("fk_pk_id_db_j") <= F.col("abort.d")))
        opened = runs.withColumn("_all", F.lit(1)).join(point, "_all").filter(abort.isNull() | before).drop("_all", "abort")
    else:
        o = outcomes.join(failed.groupBy("db_id").agg(F.min(pos).alias("abort")), "db_id", "left")
        opened = runs
    applied = o.filter(F.col("ok") & (abort.isNull() | (pos < abort))).drop("abort")
    return opened, applied, o.filter(~F.col("ok") & (pos == abort)).drop("abort")


def fold_runs(runs: DataFrame, outcomes: DataFrame, on_error: str = "stop_run", split=None) -> DataFrame:
    """The run ledger after all processed indexes.

    ``outcomes``: ``server_id, db_id, ok, schema_name, table_name, index_name, bloat_before,
    bloat_after, seconds, err_*``. Each processed index overwrites its database's row in
    ascending-bloat order, so the row keeps the last one (``max_by`` on the processing
    position, a partial aggregate per database); a database without processed indexes keeps
    its defaults. ``stop_run``: the first failure ends the whole run, and databases after it
    get no row at all.
    """
    opened, applied, _ = split or reached(outcomes, runs, on_error)
    last = applied.groupBy("db_id").agg(F.max_by(
        F.struct("bloat_before", "table_name", "index_name", "seconds", "bloat_after"), _position()).alias("_last"))
    j = opened.join(last.withColumnRenamed("db_id", "fk_pk_id_db_j"), "fk_pk_id_db_j", "left")
    return j.select(
        "run_key", "server_id", "fk_pk_id_db_j", "det_date",
        F.coalesce(F.col("_last.seconds").cast("long"), F.col("det_clocking")).alias("det_clocking"),
        F.coalesce(F.col("_last.bloat_before").cast("float"), F.col("det_perc_bloat")).alias("det_perc_bloat"),
        F.coalesce(F.col("_last.bloat_after").cast("float"), F.col("det_perc_bloat_after")).alias("det_perc_bloat_after"),
        F.coalesce(F.col("_last.table_name"), F.col("det_table_name")).alias("det_table_name"),
        F.coalesce(F.col("_last.index_name"), F.col("det_index_name")).alias("det_index_name"))


def error_rows(df: DataFrame, layout: str = "reindex", now=None) -> DataFrame:
    """Error-ledger rows; a missing text takes the table's blank (``*`` or ``;``).

    reindex: ``run_key, err_label, err_message, err_detail, err_code``.
    slicer:  ``fk_pk_id_conn, slice_now_ins, slice_err_mess, slice_err_detail, slice_err_code,
    work_scheme`` (``slice_now_ins`` defaults to ``now``), and ``pk_id_pgini`` where given: a
    server with two config rows has two errors.
    """
    if layout == "reindex":
        b = F.lit(REINDEX_ERROR_BLANK)
        return df.select(F.col("run_key").alias("fk_pk_id_db_k"),
                         *[F.coalesce(F.col(c), b).alias(c)
                           for c in ("err_label", "err_message", "err_detail", "err_code")])
    if layout == "slicer":
        b = F.lit(SLICER_ERROR_BLANK)
        ts = F.col("slice_now_ins") if "slice_now_ins" in df.columns else F.lit(None)
        if now is not None:
            ts = F.coalesce(ts.cast("timestamp_ntz"), as_ntz(now))
        own = ["pk_id_pgini"] if "pk_id_pgini" in df.columns else []
        return df.select("fk_pk_id_conn", *own, ts.cast("timestamp_ntz").alias("slice_now_ins"),
                         *[F.coalesce(F.col(c) if c in df.columns else F.lit(None).cast("string"), b).alias(c)
                           for c in ("slice_err_mess", "slice_err_detail", "slice_err_code", "work_scheme")])
    raise ValueError("layout must be 'reindex' or 'slicer'")


def run_errors(runs: DataFrame, outcomes: DataFrame, on_error: str = "stop_run", split=None) -> DataFrame:
    """W20 for index runs: the failure that stopped the run (or each database) as an
    error row of that database's ledger row; connection failures get the connect label."""
    opened, _, failures = split or reached(outcomes, runs, on_error)
    f = failures.select(F.col("db_id").alias("fk_pk_id_db_j"),
                        F.when(F.col("index_name").isNull(), F.lit(LABEL_CONNECT))
                        .otherwise(F.lit(LABEL_REINDEX)).alias("err_label"),
                        "err_message", "err_detail", "err_code")
    return error_rows(opened.select("run_key", "fk_pk_id_db_j").join(f, "fk_pk_id_db_j"), "reindex")


def append_events(events_in: DataFrame, now, user: str, id_col: str = "id") -> DataFrame:
    """Event-log rows; a missing time takes ``now`` and a missing user takes ``user``."""
    return events_in.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col("event_date").cast("timestamp_ntz"), as_ntz(now)).alias("event_date"),
        F.coalesce(F.col("user_id"), F.lit(user)).alias("user_id"),
        F.col("description"))

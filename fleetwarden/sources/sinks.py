"""Ledger sinks: append-only parquet tables in the shared folder.

The hub updates its ledgers in place; here each run appends its folded rows, and readers
take the latest row per natural key. Appends of a retried run write the same rows again, so
``current_state`` stays correct after executor or job loss. Error tables are only ever
inserted into: nothing is folded there, a retried batch's repeated rows go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwarden.functions.keys import surrogate_key

# Natural keys of the ledgers. The error tables have none: their rows count.
LEDGER_KEYS = {
    "run_ledger": ("fk_pk_id_db_j", "det_date"),
    "run_errors": ("fk_pk_id_db_k", "err_label", "err_code"),
    "slice_ledger": ("server_id", "pk_id_pgini", "run_ts"),
    "slice_errors": ("fk_pk_id_conn", "pk_id_pgini", "slice_now_ins", "slice_err_code"),
    "event_log": ("id",),
}
INSERT_ONLY = ("run_errors", "slice_errors")


def append_ledger(df: DataFrame, path: str, ledger: str, batch_ts=None) -> None:
    """Append rows with ``pk`` (hash of the key columns: a label, never an identity) and
    ``written_at`` (the batch time)."""
    ts = F.current_timestamp() if batch_ts is None else F.lit(batch_ts).cast("timestamp")
    (df.withColumn("pk", surrogate_key(*LEDGER_KEYS[ledger])).withColumn("written_at", ts.cast("timestamp_ntz"))
     .write.mode("append").parquet(path))


def current_state(spark: SparkSession, path: str, ledger: str) -> DataFrame:
    """Latest appended row per natural key (a maximum of (``written_at``, row): a partial
    aggregate, no window, and the same row however often a batch was appended). Of the
    insert-only tables, every row that differs from the others of its batch."""
    df = spark.read.parquet(path)
    if ledger in INSERT_ONLY:
        return df.distinct().drop("written_at")
    keys = LEDGER_KEYS[ledger]
    cols = [c for c in df.columns if c not in (*keys, "written_at")]
    latest = df.groupBy(*keys).agg(F.max(F.struct("written_at", *cols)).alias("_r"))
    return latest.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols])


def write_slices(rows: DataFrame, path: str, batch: str) -> str:
    """Write slice rows (``slicing.slice_rows``) as parquet under ``batch=<batch>``, one
    folder per window day, and return that folder. A run owns its batch folder: a retry
    replaces it, and other runs' slices stay.

    A rebalance by ``(server_id, window_start)`` brings a window's lines together and lets
    the adaptive planner split a server that holds a third of all lines by size, without
    sampling the lines for a range first.
    """
    out = f"{path}/batch={batch}"
    (rows.withColumn("window_day", F.to_date("window_start"))
     .hint("rebalance", "server_id", "window_start")
     .sortWithinPartitions("server_id", "window_start", "log_ts")
     .write.mode("overwrite").partitionBy("window_day").parquet(out))
    return out


def write_logs_by_day(logs: DataFrame, path: str) -> None:
    """Log lines as parquet in one ``log_day=<date>`` folder a day, each server's lines
    together and in order, so that a slice run reads the days its tasks name and, of those,
    the row groups of its servers."""
    (logs.withColumn("log_day", F.to_date("log_ts")).hint("rebalance", "log_day", "server_id")
     .sortWithinPartitions("log_day", "server_id", "log_ts").write.mode("overwrite").partitionBy("log_day").parquet(path))

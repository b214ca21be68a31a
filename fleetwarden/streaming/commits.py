"""Commit records of streams that write with ``foreachBatch``.

A micro-batch writes each of its outputs to ``<out>/<name>/batch=<id>`` and its record to
``<out>/marks/batch=<id>`` last. A replayed batch overwrites its own folders; a reader that
goes by the records never sees half a batch, nor one that is being written again: the
record goes first when a batch is replayed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetwarden.session import delete_path, path_exists

MARK = "batch long, watermark timestamp_ntz"


def begin(spark: SparkSession, out: str, batch_id: int) -> None:
    delete_path(spark, f"{out}/marks/batch={batch_id}")


def write_output(rows: DataFrame, out: str, name: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{out}/{name}/batch={batch_id}")


def commit(spark: SparkSession, out: str, batch_id: int, watermark=None) -> None:
    row = spark.createDataFrame([(watermark,)], "watermark timestamp_ntz")
    row.coalesce(1).write.mode("overwrite").parquet(f"{out}/marks/batch={batch_id}")


def marks(spark: SparkSession, out: str) -> DataFrame:
    """The batches that were written whole: ``batch, watermark``."""
    if not path_exists(spark, f"{out}/marks"):
        return spark.createDataFrame([], MARK)
    return spark.read.schema(MARK).parquet(f"{out}/marks")


def committed(spark: SparkSession, out: str, name: str, schema) -> DataFrame:
    """The rows of output ``name`` of all batches that were written whole."""
    if not path_exists(spark, f"{out}/{name}"):
        return spark.createDataFrame([], schema)
    whole = [r.batch for r in marks(spark, out).select("batch").distinct().collect()]  # a number for each batch
    paths = [p for b in sorted(whole) if path_exists(spark, p := f"{out}/{name}/batch={b}")]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

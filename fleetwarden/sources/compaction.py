"""Ledgers with compaction: a folded base and the batches that came after it.

    <path>/deltas/batch=<id>/       rows of one batch; a retried batch replaces its folder
    <path>/base/version=<n>/        the ledger folded to one row per key, clustered by key
    <path>/manifests/version=<n>/   which batches base <n> holds

A reader goes by the newest manifest that was written whole: it reads that base and the
batches it does not hold, so that the work of a read follows the open batches. Base rows
whose key no open batch has are passed on unshuffled (an anti-join with the open keys, which
Spark broadcasts by their size). The manifest is the last thing that a compaction writes: one
that was cut off leaves the reader with the base and batches of before, and is done again.
What a manifest holds stays on disk until the next compaction, for readers of the old one.

One compaction runs at a time; batches may be appended meanwhile.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwarden.functions.keys import surrogate_key
from fleetwarden.session import child_folders, delete_path, path_exists
from fleetwarden.sources.sinks import INSERT_ONLY, LEDGER_KEYS


#: Marks the folder of a batch that was written again after a base took it in.
AGAIN = "~again"


@dataclass
class Manifest:
    version: int = 0
    holds: set[str] = field(default_factory=set)


def manifest(spark: SparkSession, path: str) -> Manifest:
    """The newest manifest that was written whole; version 0 before the first compaction."""
    found = sorted(int(v.removeprefix("version=")) for v in child_folders(spark, f"{path}/manifests"))
    for version in reversed(found):
        folder = f"{path}/manifests/version={version}"
        if path_exists(spark, f"{folder}/_SUCCESS"):
            rows = spark.read.schema("batch string").parquet(folder).collect()  # the batches that are still on disk
            return Manifest(version, {r.batch for r in rows})
    return Manifest()


def append_batch(df: DataFrame, path: str, ledger: str, batch: str, batch_ts) -> None:
    """The rows of one batch. A batch that is written again replaces its rows; if a base
    holds it already, it goes into a folder of its own, whose rows win over the base's."""
    spark = df.sparkSession
    rows = df.withColumn("pk", surrogate_key(*LEDGER_KEYS[ledger])).withColumn("written_at", F.lit(batch_ts).cast("timestamp_ntz"))
    if ledger in INSERT_ONLY:
        rows = rows.distinct().withColumn("batch_id", F.lit(batch))
    seen = manifest(spark, path)
    name = f"{batch}{AGAIN}{seen.version}" if batch in seen.holds else batch
    rows.write.mode("overwrite").parquet(f"{path}/deltas/batch={name}")


def open_batches(spark: SparkSession, path: str, holds: set[str]) -> list[str]:
    return sorted({b.removeprefix("batch=") for b in child_folders(spark, f"{path}/deltas")} - holds)


def fold(rows: DataFrame, ledger: str) -> DataFrame:
    """The latest row of each key, ``written_at`` included."""
    keys = LEDGER_KEYS[ledger]
    cols = [c for c in rows.columns if c not in (*keys, "written_at")]
    latest = rows.groupBy(*keys).agg(F.max(F.struct("written_at", *cols)).alias("_r"))
    return latest.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols], F.col("_r.written_at").alias("written_at"))


def ledger_rows(spark: SparkSession, path: str, ledger: str) -> DataFrame:
    """The current rows of a ledger, ``written_at`` included."""
    seen = manifest(spark, path)
    paths = [f"{path}/deltas/batch={b}" for b in open_batches(spark, path, seen.holds)]
    base = spark.read.parquet(f"{path}/base/version={seen.version}") if seen.version else None
    if not paths:
        if base is None:
            raise FileNotFoundError(f"no batch of {ledger} under {path}")
        return base
    fresh = spark.read.parquet(*paths)
    if ledger in INSERT_ONLY:       # a batch that is open again replaces its rows in the base
        again = [b.split(AGAIN)[0] for b in open_batches(spark, path, seen.holds)]
        return fresh if base is None else base.where(~F.col("batch_id").isin(again)).unionByName(fresh)
    if base is None:
        return fold(fresh, ledger)
    keys = LEDGER_KEYS[ledger]
    named = fresh.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    same = F.lit(True)
    for k in keys:
        same = same & base[k].eqNullSafe(F.col(f"_{k}"))
    return base.join(named, same, "left_anti").unionByName(fold(base.join(named, same, "left_semi").unionByName(fresh), ledger))


def compacted_state(spark: SparkSession, path: str, ledger: str) -> DataFrame:
    """``sinks.current_state`` of a ledger with compaction."""
    return ledger_rows(spark, path, ledger).drop("written_at", "batch_id")


def compact(spark: SparkSession, path: str, ledger: str) -> int:
    """Folds base and open batches into a new base and returns its version. Batches and
    bases that the manifest before did not need any more are deleted."""
    seen = manifest(spark, path)
    now, version = open_batches(spark, path, seen.holds), seen.version + 1
    keys = LEDGER_KEYS[ledger]
    (ledger_rows(spark, path, ledger).hint("rebalance", *keys).sortWithinPartitions(*keys)
     .write.mode("overwrite").parquet(f"{path}/base/version={version}"))
    write_manifest(spark, path, version, now)
    for batch in seen.holds:
        delete_path(spark, f"{path}/deltas/batch={batch}")
    for old in range(max(1, seen.version - 1), seen.version):
        delete_path(spark, f"{path}/base/version={old}")
        delete_path(spark, f"{path}/manifests/version={old}")
    return version


def write_manifest(spark: SparkSession, path: str, version: int, holds: list[str]) -> None:
    (spark.createDataFrame([(b,) for b in holds], "batch string").coalesce(1)
     .write.mode("overwrite").parquet(f"{path}/manifests/version={version}"))

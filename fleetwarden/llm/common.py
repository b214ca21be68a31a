"""Helpers that several operators share: inputs, written intermediates, gapless numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetwarden.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word is a run of anything but the ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
#: For ``bytes.translate``: A-Z lower-cased, and a blank for each ASCII byte that is neither digit nor letter.
ALNUM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or b >= 97 and b <= 122 or b >= 128 else 32 for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its rows are then fixed (a lost
    executor re-reads files instead of replaying the plan), and its size is known to the
    optimiser, so that joins broadcast or split skewed partitions by real figures. Joins
    with whole texts are hinted to merge instead: one plan at every size."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names`` with as many underscores as keep them apart from the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def columns(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def numbered(df: DataFrame, keys: list[str], order: list[str], out: str, rows_per_chunk: int = 1_000_000) -> DataFrame:
    """Adds ``out``: 0, 1, 2, ... without gaps within each ``keys`` group.

    ``df`` must be a written table (it is read twice). A group is dealt into hash chunks of
    its first order column, so that a group holding a third of all rows is numbered by many
    tasks; a chunk's numbers start after the rows of the chunks before it, which takes a
    table of counts per (group, chunk).
    """
    chunks = max(64, df.count() // rows_per_chunk)
    chunk = F.pmod(F.xxhash64(F.col(order[0])), F.lit(chunks))
    dealt = df.withColumn("_chunk", chunk)
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(dealt.groupBy(*keys, "_chunk").count()
                     .withColumn("_start", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count"), "starts")
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    ranked = dealt.withColumn("_rank", F.row_number().over(inside) - 1)
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    cond = F.col("r._chunk") == F.col("s._chunk")
    for s in same:
        cond = cond & s
    return (ranked.alias("r").join(starts.alias("s"), cond)
            .select(*[F.col(f"r.{c}") for c in df.columns], (F.col("r._rank") + F.col("s._start")).alias(out)))

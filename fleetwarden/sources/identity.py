"""Identity columns: gapless numbers for the rows of a table that grows batch by batch.

The hub's tables number their rows with ``GENERATED ALWAYS AS IDENTITY``. Here a batch is
brought into a total order by ranges and sorted there; a row's number is its place in its
range after the rows of the ranges before it, so that only one count a range meets in one
place. The range of numbers that a batch takes is stored before its rows: a retried batch
takes the same range, and as the order is that of the rows' own columns, each row takes the
same number again.

One batch of a table is numbered at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetwarden.session import path_exists, stored

MARKS = "batch string, first long, n long"


def positions(df: DataFrame, order: list[str | Column], name: str = "position") -> DataFrame:
    """``df`` with each row's place in the total order, 0, 1, 2, ... without gaps. Rows that
    tie in all of ``order`` come in any order among themselves."""
    keys = [F.col(f"`{c}`") if isinstance(c, str) else c for c in order] + [F.col("_row")]
    ranges = df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stored(ranges.withColumn("_place", F.monotonically_increasing_id()).drop("_row"), "ranges").withColumn("_part", F.shiftright("_place", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(placed.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
                    .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))), "range-starts")
    return (placed.join(starts, "_part").withColumn(name, F.col("_place") - F.col("_first") + F.col("_start"))
            .select(*[F.col(f"`{c}`") for c in df.columns], name))


def marks(spark: SparkSession, path: str) -> DataFrame:
    """The ranges of numbers taken so far: ``batch, first, n``."""
    if not path_exists(spark, f"{path}/marks"):
        return spark.createDataFrame([], MARKS)
    return spark.read.schema(MARKS).parquet(f"{path}/marks")


def append_identified(df: DataFrame, path: str, batch: str, id_col: str, order: list[str | Column] | None = None, start: int = 1) -> DataFrame:
    """Appends ``df`` as batch ``batch`` of the table under ``path`` with ``id_col`` numbered
    on from the highest number taken, and returns the batch's rows. A batch that comes again
    keeps its range; if it has more rows than then, it takes a new one."""
    spark = df.sparkSession
    placed = positions(df, order or df.columns, "_position")
    n = placed.count()
    taken = marks(spark, path)
    own = taken.where(F.col("batch") == batch).first()
    if own and own.n >= n:
        first = own.first
    else:
        last = taken.agg(F.max(F.col("first") + F.col("n"))).first()[0]
        first = last if last is not None else start
        mark = spark.createDataFrame([(first, n)], "first long, n long")
        mark.coalesce(1).write.mode("overwrite").parquet(f"{path}/marks/batch={batch}")
    rows = placed.withColumn(id_col, F.col("_position") + first).select(id_col, *[F.col(f"`{c}`") for c in df.columns])
    folder = f"{path}/rows/batch={batch}"
    rows.write.mode("overwrite").parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def identified(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of all batches."""
    return spark.read.schema(schema).parquet(f"{path}/rows/*")

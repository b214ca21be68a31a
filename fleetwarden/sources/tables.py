"""Table readers. Parquet is the default; columns are selected right at the scan so
Catalyst prunes the ReadSchema and pushes filters into the parquet reader."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, root: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """``<root>/<name>.parquet`` (a file or a directory of part files)."""
    df = spark.read.parquet(os.path.join(root, f"{name}.parquet"))
    return df.select(*columns) if columns else df


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, num_partitions: int = 64,
              properties: dict | None = None) -> DataFrame:
    """Live read of a hub or catalog table. With a partition column the read is split
    into ``num_partitions`` range queries instead of one single-connection scan."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower)
                  .option("upperBound", upper).option("numPartitions", num_partitions))
    return reader.load()

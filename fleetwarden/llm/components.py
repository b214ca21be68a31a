"""Connected components of a graph given as an edge table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _checksum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.shiftright(F.xxhash64("u", "v"), 20))).first()
    return row[0], row[1]


def with_low(edges: DataFrame) -> DataFrame:
    """Edges with ``low``, the smallest ``v`` of their ``u``."""
    return edges.join(edges.groupBy("u").agg(F.min("v").alias("low")), "u")


def components(edges: DataFrame) -> DataFrame:
    """(``id``, ``component``) of every vertex of ``edges`` (``u``, ``v``, both long):
    the smallest vertex that it reaches.

    Each round hangs the larger neighbours of a vertex under its smallest one, then the
    smaller ones; the number of rounds grows with the logarithm of the longest path. Rounds
    are written tables and only their count and a checksum reach the driver. The smallest
    neighbour is a partial aggregate, and the join that brings it back to a vertex with very
    many edges is one that Spark broadcasts by its size or splits.
    """
    e = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while (now := _checksum(e)) != before and now[0]:
        before = now
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = with_low(both).select("u", "v", F.least("u", "low").alias("low")).where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = written(large, "large-star")
        small = with_low(large).select(F.when(F.col("v") > F.col("low"), F.col("v")).otherwise(F.col("u")).alias("a"), "u", "low")
        e = written(small.select(F.explode(F.array_distinct(F.array("a", "u"))).alias("u"), F.col("low").alias("v")).distinct(), "edges")
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())

"""Sharding by Karmarkar-Karp differencing: shards of nearly equal bytes out of groups that
must not be divided.

Rows with equal texts form a group. Groups are dealt into runs of bounded length by a hash
of their digest. A run is differenced in one task: every group starts as a partial partition
with one non-empty shard, and the two partial partitions with the largest spreads are joined
in opposite order until one is left. The runs' partial partitions (one sum per shard) go
through the same step in a reduction tree. Only those sums travel up; the shards of the
groups come back through joins, so that no task and not the driver sees all groups.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, written


def differenced(partials: list[list[tuple[int, int]]]) -> tuple[list[tuple[int, int]], list[int]]:
    """Joins partial partitions, each a list of (sum, node) with node -1 for an empty part.
    Returns the last one and each node's parent; nodes beyond the given ones are joins."""
    nodes = 1 + max((n for p in partials for _, n in p), default=-1)
    parent = [-1] * nodes
    heap = []
    for k, p in enumerate(partials):
        p = sorted(p, key=lambda e: -e[0])
        heap.append((p[-1][0] - p[0][0], k, p))
    heapq.heapify(heap)
    serial = len(heap)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        out = []
        for (s, m), (t, n) in zip(a, reversed(b)):
            if m >= 0 and n >= 0:
                parent[m] = parent[n] = len(parent)
                out.append((s + t, len(parent)))
                parent.append(-1)
            else:
                out.append((s + t, m if m >= 0 else n))
        out.sort(key=lambda e: -e[0])
        heapq.heappush(heap, (out[-1][0] - out[0][0], serial, out))
        serial += 1
    return (heap[0][2] if heap else []), parent


def labels(last: list[tuple[int, int]], parent: list[int]) -> list[int]:
    """The part that each node ends in."""
    part = [-1] * len(parent)
    for k, (_, n) in enumerate(last):
        if n >= 0:
            part[n] = k
    for n in range(len(parent) - 1, -1, -1):
        if part[n] < 0 and parent[n] >= 0:
            part[n] = part[parent[n]]
    return part


def difference_groups(shards: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("digest", kind="stable")
        empty = [(0, -1)] * (shards - 1)
        last, parent = differenced([[(s, k), *empty] for k, s in enumerate(group["bytes"].tolist())])
        return group.assign(part=labels(last, parent)[: len(group)])
    return run


def join_runs(shards: int):
    """One round up the tree: the runs of a block become one; returns where each part went."""
    def block(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["run", "part"], kind="stable").reset_index(drop=True)
        partials = []
        for _, rows in group.groupby("run", sort=True):
            mine = [(int(b), int(k)) for k, b in rows["bytes"].items()]
            partials.append(mine + [(0, -1)] * (shards - len(mine)))
        last, parent = differenced(partials)
        return group.assign(to=labels(last, parent)[: len(group)])
    return block


def shard_by_bytes(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
                   overhead: int = 16, run_groups: int = 2000, fan_in: int = 32) -> DataFrame:
    """One row per row of ``docs``: id, ``size`` (UTF-8 bytes plus ``overhead``),
    ``text_crc32``, ``law`` ("bytes"), ``shard``, ``slot`` (gapless from 0 within the shard)
    and ``grown_shard`` (null: this law moves rows when the number of shards changes).

    Equal texts go to one shard. Null text has no bytes, and shares its group with the
    empty text. A group larger than a mean shard fills a shard of its own; the others stay
    level. Repeated rows count one by one; further columns are ignored; an empty table
    gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = written(docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("t"))
                   .select("doc_id", (F.octet_length("t") + overhead).cast("long").alias("size"),
                           F.crc32(F.col("t").cast("binary")).alias("text_crc32"), F.sha2("t", 256).alias("digest"),
                           F.monotonically_increasing_id().alias("row")), "sized")
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"))
    groups = written(groups, "groups")
    runs = max(1, -(-groups.count() // run_groups))
    groups = groups.withColumn("run", F.pmod(F.xxhash64("digest"), F.lit(runs)))
    placed = written(groups.groupBy("run").applyInPandas(
        difference_groups(shards), "digest string, bytes long, run long, part long"), "placed")
    sums = placed.groupBy("run", "part").agg(F.sum("bytes").alias("bytes"))
    moved = sums.select("run", "part", "bytes", F.col("run").alias("at"), F.col("part").alias("to"))
    while runs > 1:
        runs = -(-runs // fan_in)
        tops = (moved.groupBy(F.col("at").alias("run"), F.col("to").alias("part")).agg(F.sum("bytes").alias("bytes"))
                .withColumn("block", F.floor(F.col("run") / fan_in)))
        step = written(tops.groupBy("block").applyInPandas(
            join_runs(shards), "run long, part long, bytes long, block long, to long"), "joined")
        moved = written(moved.join(step.select(F.col("run").alias("at"), F.col("part").alias("to"), "block", F.col("to").alias("next")),
                                   ["at", "to"]).select("run", "part", "bytes", F.col("block").alias("at"), F.col("next").alias("to")), "moved")
    of_group = written(placed.join(moved.select("run", "part", "to"), ["run", "part"])
                       .select("digest", F.col("to").cast("int").alias("shard")), "of-group")
    dealt = written(rows.join(of_group, "digest").drop("digest"), "dealt")
    return (numbered(dealt, ["shard"], ["doc_id", "row"], "slot")
            .select(F.col("doc_id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")))

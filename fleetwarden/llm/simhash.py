"""SimHash near-dedup by pigeonhole blocks.

A fingerprint has 64 bits: bit b is set where over half of a text's shingle hashes have it.
Fingerprints are compared once each, however many documents share them. They are split into
``max_distance + 2`` blocks; two that differ in at most ``max_distance`` bits agree in at
least two of the blocks, so they meet in a bucket keyed by two blocks (32 bits at distance
2), where their Hamming distance is verified.

A bucket of many fingerprints is not joined with itself. There each fingerprint names the
points within half the distance of itself, and all that name a point are tied to the
smallest one: two fingerprints within the distance always name a common point, and a tie
never exceeds the distance. That is exact and grows with the bucket's rows, not pairs.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns, fresh, written
from .components import components

SEED = 42
#: Shingles whose votes are counted together.
BLOCK = 1 << 15


def fingerprint(text: str | None, shingle_words: int) -> bytes:
    """Eight big-endian bytes. A-Z are lower-cased, words are runs without ASCII white
    space, shingles count with repeats; fewer words form one shingle, none give zero."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return bytes(8)
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts, k = [0, *ends], min(shingle_words, len(words))
    digest, n, votes = xxhash.xxh64_digest, len(words) - k + 1, np.zeros(64, dtype=np.int64)
    for at in range(0, n, BLOCK):
        hashes = b"".join([digest(joined[a: b - 1], SEED) for a, b in zip(starts[at: at + BLOCK], ends[at + k - 1: at + k - 1 + BLOCK])])
        votes += np.unpackbits(np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * votes > n).tobytes()


def fingerprints(shingle_words: int):
    def batches(it):
        for batch in it:
            fp = [int.from_bytes(fingerprint(t.as_py(), shingle_words), "big", signed=True) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp, pa.int64())], ["doc_id", "row", "fp"])
    return batches


def _signed(bits: list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >= 1 << 63 else value


def bucket_masks(max_distance: int) -> list[int]:
    """Masks of the bits that must agree: every choice of two among the blocks."""
    n = max_distance + 2
    blocks = [[b for b in range(64) if b * n // 64 == k] for k in range(n)]
    return [_signed(sum((blocks[k] for k in chosen), [])) for chosen in combinations(range(n), 2)]


def close_links(fps: DataFrame, max_distance: int, dense: int = 32) -> DataFrame:
    """Edges (``u``, ``v``) between the distinct fingerprints of ``fps`` (column ``fp``)
    whose components are those of all pairs within ``max_distance`` bits."""
    masks = bucket_masks(max_distance)
    near = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_distance
    entries = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("mask", "key"))
    sizes = entries.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(entries.join(sizes, ["mask", "key"]), "shared")
    few = shared.where(F.col("n") <= dense)
    links = (few.alias("a").join(few.alias("b"), ["mask", "key"]).where((F.col("a.fp") < F.col("b.fp")) & near)
             .select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v")))
    flips = [0] + [_signed(list(c)) for k in range(1, (max_distance + 1) // 2 + 1) for c in combinations(range(64), k)]
    crowded = shared.where(F.col("n") > dense).select("fp").distinct()
    points = (crowded.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(f)) for f in flips])).alias("point"))
              .withColumn("off", F.bit_count(F.col("fp").bitwiseXOR(F.col("point")))))
    hubs = (points.groupBy("point").agg(F.min(F.when(F.col("off") <= max_distance // 2, F.col("fp"))).alias("fp"), F.count("*").alias("n"))
            .where("n > 1 AND fp IS NOT NULL"))
    ties = (points.alias("a").join(hubs.alias("b"), "point").where((F.col("a.fp") != F.col("b.fp")) & near)
            .select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v")))
    return links.unionByName(ties)


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
                   max_distance: int = 2, row_col: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``row`` (a number of the row,
    or ``row_col``),
    ``fingerprint`` (16 hexadecimal digits), ``component_id`` (the smallest identifier
    reachable over links, its own included) and ``keeper`` (true for one row of each
    component: the smallest identifier, then the first row).

    A text of any length is read whole, its votes counted block by block. Null, empty and
    blank texts have fingerprint zero and are linked like any other.
    Repeated rows share a fingerprint and so a component. Further columns are ignored; an
    empty table gives an empty result.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row"),
                         F.col(text_col).alias("text"))
    rows = written(source.mapInArrow(fingerprints(shingle_words), "doc_id long, row long, fp long"), "fingerprints")
    first = F.min(F.struct("doc_id", "row"))
    fps = written(rows.groupBy("fp").agg(first.alias("first")), "distinct")
    joined = components(close_links(fps, max_distance))
    # fingerprints without links are components of their own and skip the joins
    linked = fps.join(joined.withColumnRenamed("id", "fp"), "fp").select("fp", "component", "first")
    lowest = linked.groupBy("component").agg(F.min("first").alias("lowest"))
    linked = written(linked.join(lowest, "component").select("fp", "lowest"), "components")
    of_fp = written(fps.join(linked, "fp", "left").select("fp", F.coalesce("lowest", "first").alias("lowest")), "of-fp")
    return (rows.join(of_fp, "fp")
            .select("doc_id", "row", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.col("lowest.doc_id").alias("component_id"), (F.col("row") == F.col("lowest.row")).alias("keeper")))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
                     max_distance: int = 2) -> DataFrame:
    """The rows of ``docs`` that are the ``keeper`` of their component, all columns kept."""
    (clash,) = fresh(docs, "_row")
    marked = written(docs.withColumn(clash, F.monotonically_increasing_id()), "marked")
    groups = simhash_groups(marked, id_col, text_col, shingle_words, max_distance, row_col=clash)
    keepers = written(groups.where("keeper").select(F.col("row").alias(clash)), "keepers")
    return marked.join(keepers.hint("merge"), clash, "left_semi").select(*columns(docs))

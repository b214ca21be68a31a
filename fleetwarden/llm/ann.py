"""Approximate nearest neighbours by inner product, with an adaptive dimension scan.

Vectors are dealt into inverted lists by k-means. One more component, which brings every
vector to the largest norm, turns the largest inner product into the smallest distance, so
that lists work for vectors of any norm. A query first searches its nearest list in full;
its k-th score there is the bar for the other lists it probes.

There, vectors are rotated at random and scanned in blocks of columns. After each block a
hypothesis test decides which candidates go on: the part of the product still unseen behaves
like a normal variable whose spread is the product of the remaining norms over the root of
the remaining dimensions; a candidate that would need more than ``epsilon`` spreads to reach
the bar is abandoned. What survives is scored exactly on the original vectors.

Centroids, rotation and the number of probes come from a bounded sample; every vector is
indexed. Lists are cut into chunks of bounded length, each a task's work.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written


#: Rows whose distances from all lists are worked out at a time.
ROWS = 1024


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(``row``, ``id``, ``v``) of the vectors that take part: not null, not zero, without
    null or non-finite components, and of the most frequent dimension."""
    v = F.col("v")
    ok = (F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
    rows = written(vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
                   .where(F.col("id").isNotNull() & v.isNotNull() & F.coalesce(ok, F.lit(False)))
                   .withColumn("row", F.monotonically_increasing_id()), "vectors")
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (sizes["d"] if sizes else 0))


class Index:
    """Centroids (with the extra component), rotation and probes, all from the sample."""

    def __init__(self, sample: np.ndarray, largest: float, lists: int, k: int, recall: float, seed: int):
        rng = np.random.default_rng(seed)
        self.largest = largest
        d = sample.shape[1]
        self.rotation = np.linalg.qr(rng.standard_normal((d, d)))[0]
        full = self.extended(sample)
        self.centroids = full[rng.permutation(len(full))[:lists]]
        for _ in range(8):
            own = self.nearest(full, 1)[:, 0]
            sums = np.zeros_like(self.centroids)
            np.add.at(sums, own, full)
            n = np.bincount(own, minlength=len(sums))[:, None]
            self.centroids = np.where(n > 0, sums / np.maximum(n, 1), self.centroids)
        # lists that hold the sample's own true neighbours: a sparser set needs more probes, not fewer
        own = self.nearest(full, 1)[:, 0]
        different = np.unique(sample, axis=0, return_index=True)[1]  # copies find each other at once and tell nothing
        asked = rng.permutation(different)[:256]
        scores = sample[asked] @ sample.T
        scores[np.arange(len(asked)), asked] = -np.inf
        best = np.argpartition(-scores, min(k, len(full) - 1) - 1, axis=1)[:, :k] if len(full) > 1 else np.zeros((len(asked), 1), int)
        order = np.argsort(np.argsort(self.gaps(self.queries(sample[asked])), axis=1), axis=1)
        ranks = np.take_along_axis(order, own[best], axis=1)
        self.probes = int(np.quantile(ranks, recall)) + 1

    def extended(self, v: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.largest ** 2 - (v * v).sum(axis=1, keepdims=True), 0))
        return np.hstack([v, rest])

    def queries(self, q: np.ndarray) -> np.ndarray:
        """Queries have no extra component; their length is free, so they get the common one."""
        q = q * (self.largest / np.linalg.norm(q, axis=1, keepdims=True))
        return np.hstack([q, np.zeros((len(q), 1))])

    def gaps(self, v: np.ndarray) -> np.ndarray:
        return (self.centroids ** 2).sum(axis=1) - 2 * (v @ self.centroids.T)

    def nearest(self, v: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` nearest lists of each row, nearest first; distances of ROWS rows at a time."""
        out = [np.zeros((0, n), dtype=np.int64)]
        for at in range(0, len(v), ROWS):
            gaps = self.gaps(v[at: at + ROWS])
            if n == 1:
                out.append(gaps.argmin(axis=1)[:, None])
                continue
            near = np.argpartition(gaps, n - 1, axis=1)[:, :n] if n < gaps.shape[1] else np.tile(np.arange(n), (len(gaps), 1))
            out.append(np.take_along_axis(near, np.argsort(np.take_along_axis(gaps, near, axis=1), axis=1, kind="stable"), axis=1))
        return np.concatenate(out)


def _matrix(column) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def deal(index: Index):
    def batches(it):
        for batch in it:
            v = _matrix(batch.column(2)) if len(batch) else np.zeros((0, 1))
            own = index.nearest(index.extended(v), 1)[:, 0] if len(batch) else np.zeros(0, int)
            off = np.linalg.norm(v - index.centroids[own, :-1], axis=1) if len(batch) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.int32()), pa.array(off)], ["row", "id", "v", "list", "off"])
    return batches


def probe(index: Index):
    def batches(it):
        for batch in it:
            if len(batch):
                v = _matrix(batch.column(2))
                near = index.nearest(index.queries(v), index.probes)
                toward = np.stack([index.centroids[n, :-1] @ q for n, q in zip(near, v)])
                ends = pa.array(np.arange(0, near.size + 1, near.shape[1]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.ListArray.from_arrays(ends, pa.array(near.ravel(), pa.int32())), pa.ListArray.from_arrays(ends, pa.array(toward.ravel())),
                     pa.array(np.linalg.norm(v, axis=1))], ["row", "id", "v", "lists", "toward", "norm"])
    return batches


def scan(index: Index, k: int, block: int, epsilon: float):
    """Searches one chunk of a list for all queries that probe it. Queries with a bar are
    scanned block by block; the others in full."""
    def search(key, asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(asked) and len(held):
            x = np.stack(held["v"].to_numpy())
            rows, ids = held["row"].to_numpy(), held["id"].to_numpy()
            xr = x @ index.rotation
            x_rest = np.sqrt(np.maximum(np.cumsum((xr * xr)[:, ::-1], axis=1)[:, ::-1], 0))  # norm from a column on
            d = x.shape[1]
            for at in range(0, len(asked), 128):
                part = asked.iloc[at: at + 128]
                q = np.stack(part["v"].to_numpy())
                bar = part["bar"].to_numpy()
                qr = q @ index.rotation
                q_rest = np.sqrt(np.maximum(np.cumsum((qr * qr)[:, ::-1], axis=1)[:, ::-1], 0))
                qi, xi = np.nonzero(part["row"].to_numpy()[:, None] != rows[None, :])
                seen = np.zeros(len(qi))
                for a in range(0, d, block):
                    b = min(a + block, d)
                    if a == 0:
                        seen = (qr[:, :b] @ xr[:, :b].T)[qi, xi]
                    else:
                        seen = seen + np.einsum("ij,ij->i", qr[qi, a:b], xr[xi, a:b])
                    spread = q_rest[qi, b] * x_rest[xi, b] / np.sqrt(d - b) if b < d else 1e-9 * q_rest[qi, 0] * x_rest[xi, 0]
                    on = seen + epsilon * spread >= bar[qi]
                    qi, xi, seen = qi[on], xi[on], seen[on]
                score = np.einsum("ij,ij->i", q[qi], x[xi])
                order = np.lexsort((ids[xi], -score, qi))
                qi, xi, score = qi[order], xi[order], score[order]
                starts = np.searchsorted(qi, qi)
                top = np.arange(len(qi)) - starts < k
                found.append(pd.DataFrame({"query_row": part["row"].to_numpy()[qi[top]], "query_id": part["id"].to_numpy()[qi[top]],
                                           "vec_id": ids[xi[top]], "score": score[top]}))
        empty = pd.DataFrame({"query_row": [], "query_id": [], "vec_id": [], "score": []})
        return pd.concat(found) if found else empty
    return search


def nearest_neighbours(vectors: DataFrame, queries_where: str = "id % 20 = 0", k: int = 20, id_col: str = "vec_id",
                       vec_col: str = "embedding", sample_rows: int = 10_000, recall: float = 0.985, block: int = 16,
                       epsilon: float = 3.5, chunk_rows: int = 1000, query_rows: int = 4000, seed: int = 42) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` nearest found of
    each query row, ties to the smaller identifier. ``queries_where`` selects the queries by
    ``id``; candidates are all rows but the query's own.

    Vectors that are null, zero, hold null or non-finite components, have another dimension
    than most, or have no identifier take no part. Rows that repeat an identifier are
    queries and candidates each. A query with fewer candidates gets all that its probes
    hold; equal vectors tie by identifier. A task holds ``chunk_rows`` candidates and
    ``query_rows`` queries on average, whatever the size of a list. Further columns are
    ignored; an empty table gives an empty result.
    ``sample_rows`` bounds what the driver sees, to fit the index only.
    """
    spark = vectors.sparkSession
    out = "query_row long, query_id long, vec_id long, score double"
    rows = usable(vectors, id_col, vec_col)
    n, largest = rows.agg(F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()
    if n < 2:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = _matrix(rows.orderBy(F.xxhash64("id", "row")).limit(sample_rows).select("v").toArrow().column("v"))
    index = Index(sample, float(np.sqrt(largest)), max(1, min(int(np.sqrt(n)), 4096, len(sample) // 4 or 1)), k, recall, seed)
    kinds = "row long, id long, v array<double>, "
    held = written(rows.select("row", "id", "v").mapInArrow(deal(index), kinds + "list int, off double"), "listed")
    lists = written(held.groupBy("list").agg(F.ceil(F.count("*") / chunk_rows).alias("chunks"), F.max("off").alias("radius")), "list-sizes")
    held = held.join(lists, "list").withColumn("chunk", F.pmod(F.xxhash64("row"), F.col("chunks"))).drop("chunks", "radius", "off")
    held = written(held, "chunked")
    asked = written(rows.where(queries_where).select("row", "id", "v")
                    .mapInArrow(probe(index), kinds + "lists array<int>, toward array<double>, norm double"), "asked")

    def search(queries: DataFrame) -> DataFrame:
        """Each query against the chunks of its list. A query does not visit a list where
        even the member farthest out in its direction would stay below its bar. Queries of
        a list are dealt into parts, each of which meets every chunk."""
        reach = F.col("toward") + F.col("norm") * F.col("radius") * (1 + 1e-9) + 1e-9
        visits = queries.join(lists, "list").where(reach >= F.col("bar"))
        parts = visits.groupBy("list").agg(F.ceil(F.count("*") / query_rows).alias("parts"))
        parts = written(parts, "query-parts")
        dealt = visits.join(parts, "list").withColumn("part", F.pmod(F.xxhash64("row", F.lit(1)), F.col("parts")))
        spread = (dealt.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
                  .select("list", "chunk", "part", "row", "id", "v", "bar"))
        met = held.join(parts, "list").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        return (spread.groupBy("list", "chunk", "part").cogroup(met.select("list", "chunk", "part", "row", "id", "v").groupBy("list", "chunk", "part"))
                .applyInPandas(scan(index, k, block, epsilon), out))

    first = written(search(asked.select(F.get("lists", F.lit(0)).alias("list"), "row", "id", "v", F.get("toward", F.lit(0)).alias("toward"), "norm",
                                        F.lit(float("-inf")).alias("bar"))), "first-lists")
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    bars = written(first.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k)
                   .select(F.col("query_row").alias("row"), F.col("score").alias("bar")), "bars")
    visit = F.explode(F.slice(F.arrays_zip("lists", "toward"), 2, index.probes)).alias("x")
    others = (asked.join(bars, "row", "left").select(visit, "row", "id", "v", "norm", F.coalesce("bar", F.lit(float("-inf"))).alias("bar"))
              .select("x.lists", "x.toward", "row", "id", "v", "norm", "bar").withColumnRenamed("lists", "list"))
    found = first.unionByName(search(others)) if index.probes > 1 else first
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))

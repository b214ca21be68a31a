"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source starts with the same fractional number of copies, target over
source size. Whole copies are certain; the fractional parts are rounded in pairs: two
documents trade word mass in a random direction until one of them is integral, which keeps
the words of the pair, and so of the source, unchanged and every expected count right. A
group of documents thus ends with one fractional document at most. These residuals meet
again one round up the reduction tree. The last one of a source becomes integral together
with the one other document of its round that leaves the words closest to the target, so
that they differ from it by half a document at most, and usually by a few words.

Fixed numbers of rows per group keep every task small whatever share a source holds, and
the draws are hashes of document identifiers, so that reruns agree on any cluster.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, columns, fresh, written


def word_count(text_col: str):
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row per source with ``rows``, ``source_size`` and ``target``.

    ``sizes`` has ``source`` and ``size``. Sources in code point order (null last) weigh
    ``weights``, repeating. ``share`` of all sizes is dealt by weight; no target exceeds
    ``cap`` times its source's size, and what is cut goes to the others by weight. In the
    order of cap over weight the cut sources come first, so that the final level per unit
    of weight follows from running sums.
    """
    per = sizes.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    k = (F.row_number().over(order) - 1) % len(weights)
    per = (per.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (k + 1).cast("int")))
           .withColumn("top", F.col("source_size") * F.lit(float(cap))).withColumn("ratio", F.col("top") / F.col("w")))
    by = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    left = (F.sum("source_size").over(everything) * F.lit(float(share))
            - F.coalesce(F.sum("top").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    per = per.withColumn("level", left / F.sum("w").over(by.rowsBetween(0, Window.unboundedFollowing)))
    # the level rises while cut sources give their excess away, and falls once uncut ones do
    target = F.least(F.col("top"), F.col("w") * F.max("level").over(everything))
    return per.select("source", "rows", "source_size", target.alias("target"))


def pair_off(group: pd.DataFrame) -> pd.DataFrame:
    """Rounds the fractions ``x`` of one group; at most one row stays fractional. Large
    documents pair with large ones first, so that what remains is small."""
    group = group.sort_values(["size", "doc_id", "row"], ascending=[False, True, True], kind="stable")
    size, x, draw = group["size"].tolist(), group["x"].tolist(), group["draw"].tolist()
    held = -1
    for d in range(len(x)):
        if not 0.0 < x[d] < 1.0:
            continue
        if held < 0:
            held = d
            continue
        c = held
        up = min((1 - x[c]) * size[c], x[d] * size[d])  # mass that d can give to c
        down = min(x[c] * size[c], (1 - x[d]) * size[d])
        if draw[d] * (up + down) < down:
            x[c], x[d] = x[c] + up / size[c], x[d] - up / size[d]
            done_c = (1 - x[c]) * size[c] <= x[d] * size[d]
            if done_c:
                x[c] = 1.0
            else:
                x[d] = 0.0
        else:
            x[c], x[d] = x[c] - down / size[c], x[d] + down / size[d]
            done_c = x[c] * size[c] <= (1 - x[d]) * size[d]
            if done_c:
                x[c] = 0.0
            else:
                x[d] = 1.0
        near = d if done_c else c
        if x[near] < 1e-12 or x[near] > 1 - 1e-12:
            x[near] = float(round(x[near]))
            held = -1
        else:
            held = near
    if held >= 0 and group["runs"].iloc[0] == 1:
        close(x, size, held)
    return group.assign(x=x)


def close(x: list[float], size: list[int], held: int) -> None:
    """Settles the last fractional row of a source: it goes to 0 or 1, alone or with the one
    other row whose change brings the words closest to what they should be."""
    best = min((abs(x[held] - to) * size[held], to, -1) for to in (0.0, 1.0))
    for k in range(len(x)):
        if k != held and size[k]:
            to = x[k]  # a row at 0 may take over what the last one gives up, and the reverse
            best = min(best, (abs((x[held] - to) * size[held] - (1 - 2 * to) * size[k]), to, k))
    x[held] = best[1]
    if best[2] >= 0:
        x[best[2]] = 1.0 - best[1]


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple = (3, 1, 2), share: float = 1.5, cap: float = 2.0, group_rows: int = 2000,
                fan_in: int = 64, seed: int = 42, row_col: str | None = None) -> DataFrame:
    """One row per row of ``docs``: id, source, ``size`` (words), ``source_size``,
    ``target``, ``copies`` (0 to ``cap``), ``taken`` (copies times size) and ``row`` (a
    number of the row, or ``row_col``).

    Null and empty texts have size 0 and take no words; their fraction is rounded by its
    own draw. Rows of a null source form a source of their own. Repeated rows are rounded
    one by one. Further columns are ignored; an empty table gives an empty result.
    """
    u = (F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.lit(seed)), 11) / F.lit(float(1 << 53)))
    sizes = written(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"),
                                word_count(text_col).alias("size"), u.alias("draw"),
                                (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row")), "sizes")
    targets = written(source_targets(sizes, weights, share, cap), "targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    runs = F.ceil(F.col("t.rows") / group_rows)
    rated = (sizes.alias("d").join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
             .select("d.doc_id", "d.source", "d.size", "d.draw", "d.row", "t.source_size", "t.target",
                     F.floor(ratio).alias("base"), (ratio - F.floor(ratio)).alias("part"), runs.alias("runs"),
                     F.pmod(F.xxhash64("d.doc_id", F.lit(seed + 1)), runs).alias("run")))
    # size 0 has no mass to trade: its fraction is drawn on its own
    rated = rated.withColumn("x", F.when(F.col("size") == 0, (F.col("draw") < F.col("part")).cast("double")).otherwise(F.col("part")))
    cols = ["doc_id", "source", "size", "draw", "row", "source_size", "target", "base", "runs", "run", "x"]
    schema = rated.select(*cols).schema
    level = written(rated.select(*cols).groupBy("source", "run").applyInPandas(pair_off, schema), "rounded-0")
    open_ = (F.col("x") > 0) & (F.col("x") < 1)
    done, k = [level.where(~open_)], targets.agg(F.max(F.ceil(F.col("rows") / group_rows))).first()[0] or 0
    while k > 1:  # one round of the tree per factor of fan_in in the runs of the largest source
        k = -(-k // fan_in)
        level = written(level.where(open_).withColumn("run", F.floor(F.col("run") / fan_in))
                        .withColumn("runs", F.ceil(F.col("runs") / fan_in)).select(*cols)
                        .groupBy("source", "run").applyInPandas(pair_off, schema), f"rounded-{k}")
        done.append(level.where(~open_))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    copies = (F.col("base") + F.col("x")).cast("long")
    return out.select(F.col("doc_id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
                      copies.alias("copies"), (copies * F.col("size")).alias("taken"), "row")


def take_mix(docs: DataFrame, id_col: str = "doc_id", **mixing) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, all columns kept."""
    clash, n = fresh(docs, "_row", "_copies")
    marked = written(docs.withColumn(clash, F.monotonically_increasing_id()), "marked")
    mix = mix_sources(marked, id_col, row_col=clash, **mixing).where(F.col("copies") > 0)
    mix = written(mix.select(F.col("row").alias(clash), F.col("copies").alias(n)), "mix")
    return (marked.join(mix.hint("merge"), clash).withColumn(n, F.explode(F.sequence(F.lit(1), F.col(n).cast("int"))))
            .select(*columns(docs)))

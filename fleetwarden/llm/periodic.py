"""Periodic runs of words, by a sparse dynamic programme over diagonals.

The diagonal of lag q holds, for each word, for how many words back the text has agreed with
itself q words earlier. A word's earlier occurrences increment the diagonals of their lags;
a diagonal that is not incremented ends, and if it is long enough its stretch is emitted.

Lags below ``DENSE`` are walked as they are. Longer ones are sparse, and the words are
blocks there: a lag between 2b and 4b can only make a run if at least 2b words agree, so
that one of the blocks that start at every b-th word agrees as a whole. For each such block
its earlier occurrences at those lags increment the diagonals by b words at a time, and where
a diagonal ends, the agreement of shorter blocks gives its exact ends. Blocks of twice the
length are named by the pair of names they consist of; a block that does not recur has no
name and is never looked at again. So a text of n words costs O(n log n) even where all its
words are equal.

A stretch that has a shorter period as well is emitted for both lags with the same ends; the
smallest lag is its period.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lags below are walked word by word; a power of two.
DENSE = 16
#: Words of the texts that are searched together.
GROUP = 1 << 18
RUNS = "array<struct<start: long, length: long, period: long>>"


def _agree(name: np.ndarray, at: np.ndarray, lag: np.ndarray, size: int) -> np.ndarray:
    """Whether the blocks of ``size`` words at ``at`` exist and equal those ``lag`` before."""
    inside = (at >= lag) & (at + size <= len(name))
    here = name[np.where(inside, at, 0)]
    return inside & (here >= 0) & (here == name[np.where(inside, at - lag, 0)])


def dense_diagonals(codes: np.ndarray, min_words: int):
    for q in range(1, min(DENSE, len(codes))):
        breaks = np.concatenate([[-1], np.flatnonzero(codes[q:] != codes[:-q]), [len(codes) - q]])
        at = np.flatnonzero(np.diff(breaks) - 1 >= max(min_words - q, q))
        yield breaks[at] + 1, breaks[at + 1] + q, np.full(len(at), q, dtype=np.int64)


def sparse_diagonals(names: list[np.ndarray], at: np.ndarray, min_words: int):
    """Ends and lags of the diagonals of lags 2b to 4b - 1, where ``names[-1]`` are the
    blocks of b words and ``at`` the places whose block recurs."""
    n, b = len(names[0]), 1 << (len(names) - 1)
    keys = np.sort(names[-1][at].astype(np.int64) * n + at)
    anchors = at[(at % b == 0) & (at >= 2 * b)]
    base = names[-1][anchors].astype(np.int64) * n
    lo = np.searchsorted(keys, base + np.maximum(anchors - 4 * b + 1, 0))
    hits = np.searchsorted(keys, base + anchors - 2 * b, side="right") - lo
    anchor = np.repeat(anchors, hits)
    first = np.repeat(lo - (np.cumsum(hits) - hits), hits)
    lag = anchor - keys[first + np.arange(len(anchor))] % n
    order = np.lexsort((anchor, lag))
    anchor, lag = anchor[order], lag[order]
    breaks = np.flatnonzero((np.diff(lag) != 0) | (np.diff(anchor) != b)) + 1
    starts, ends = np.concatenate([[0], breaks]), np.concatenate([breaks, [len(lag)]]) - 1
    if not len(lag):
        return
    s, e, lag = anchor[starts], anchor[ends] + b, lag[starts]
    for k in range(len(names) - 2, -1, -1):
        s = s - (_agree(names[k], s - (1 << k), lag, 1 << k).astype(np.int64) << k)
        e = e + (_agree(names[k], e, lag, 1 << k).astype(np.int64) << k)
    long = e - s >= np.maximum(min_words - lag, lag)
    yield s[long] - lag[long], e[long], lag[long]


def smallest(found: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Each stretch once, with its smallest lag, by start and period."""
    start, end, lag = (np.concatenate([f[k] for f in found]) for k in range(3))
    order = np.lexsort((lag, end, start))
    start, end, lag = start[order], end[order], lag[order]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, lag = start[new], end[new], lag[new]
    order = np.lexsort((lag, start))
    return start[order], end[order], lag[order]


def runs(codes: np.ndarray, min_words: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends (exclusive) and periods of the runs in ``codes`` (numbers of words, each
    number in one text only): maximal stretches of at least ``min_words`` words and two periods."""
    empty = np.zeros(0, dtype=np.int64)
    found = [(empty, empty, empty), *dense_diagonals(codes, min_words)]
    n = len(codes)
    recurs = np.bincount(codes, minlength=1)[codes] > 1
    names, at = [np.where(recurs, codes, -1).astype(np.int32)], np.flatnonzero(recurs)
    while len(at):
        b = 1 << (len(names) - 1)
        if 2 * b >= DENSE:
            found = [smallest([*found, *sparse_diagonals(names, at, min_words)])]
        at = at[at + 2 * b <= n]
        at = at[names[-1][at + b] >= 0]
        pair = names[-1][at].astype(np.int64) * n + names[-1][at + b]
        _, name, times = np.unique(pair, return_inverse=True, return_counts=True)
        again = times[name] > 1
        at, name = at[again], name[again]
        wider = np.full(n, -1, dtype=np.int32)
        wider[at] = name
        names.append(wider)
    return smallest(found)


def _batch(ids: pa.Array, texts: list[list[bytes]], codes: list[int], min_words: int) -> pa.RecordBatch:
    n_words = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(n_words)
    start, end, period = runs(np.array(codes, dtype=np.int64), min_words)
    steps = np.bincount(start + period, minlength=len(codes) + 1) - np.bincount(end, minlength=len(codes) + 1)
    kept = np.cumsum(steps[:-1]) == 0
    of = np.searchsorted(ends, start, side="right")
    collapsed = []
    for words, to, n in zip(texts, ends.tolist(), n_words.tolist()):
        stay = kept[to - n: to]
        collapsed.append(b" ".join(words if stay.all() else [w for w, k in zip(words, stay) if k]))
    offsets = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(texts)))])
    rows = pa.StructArray.from_arrays([pa.array(start - (ends - n_words)[of], pa.int64()), pa.array(end - start, pa.int64()),
                                       pa.array(period, pa.int64())], ["start", "length", "period"])
    return pa.RecordBatch.from_arrays([ids, pa.array(n_words, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows),
                                       pa.array(collapsed, pa.binary())], ["doc_id", "n_words", "runs", "collapsed"])


def searched(min_words: int):
    def batches(it):
        for batch in it:
            texts, codes, top, at = [], [], 0, 0
            for k in range(batch.num_rows):
                texts.append((batch.column(1)[k].as_py() or b"").split())
                seen: dict[bytes, int] = {}
                codes += [seen.setdefault(w, top + len(seen)) for w in texts[-1]]
                top += len(seen)
                if len(codes) >= GROUP or k + 1 == batch.num_rows:
                    yield _batch(batch.column(0).slice(at, len(texts)), texts, codes, min_words)
                    texts, codes, top, at = [], [], 0, k + 1
    return batches


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 12) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``runs`` (start, length and
    period in words, by start, then period) and ``collapsed``, the words that no run contains
    after its first period, joined by one space.

    Words are runs of anything but ASCII white space. A run is a stretch with smallest
    period q and at least ``max(min_words, 2 q)`` words that no neighbouring word extends.
    Null, empty and blank texts have no words, no runs and an empty ``collapsed``. Repeated
    rows and identifiers are rows of their own, a null identifier stays null. A text is
    searched whole, however long; a task holds some 200 bytes a word of its longest text.
    Further columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return (rows.mapInArrow(searched(min_words), f"doc_id long, n_words long, runs {RUNS}, collapsed binary")
            .withColumn("collapsed", F.col("collapsed").cast("string")))

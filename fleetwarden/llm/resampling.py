"""Importance resampling towards a target distribution, by hashed word runs.

1. A task scans its texts with an Aho-Corasick automaton over the distinct words met so far,
   each bounded by blanks on both sides, so that every match is one whole word. A match
   emits the word's payload: its CRC, the CRC of blank and word, and their length.
2. The CRC of a run of words is composed from the payloads of neighbouring matches (a CRC is
   linear: that of the left part is moved on by the length of the right one), so that runs
   are never built as strings. The CRC modulo ``buckets`` is the feature's bucket. Buckets
   are written once for each document and read by the two steps that follow.
3. Buckets are counted in each task, over all documents and over all target texts; at most
   ``buckets`` counts reach the driver. A bucket's gain is the logarithm of its smoothed
   share in the target over that in the documents.
4. A document's weight is its features' mean gain. Gumbel noise made from its identifier
   turns the largest scores into a draw without replacement.

The dictionary belongs to a task: it takes in the words of each group of texts before that
group is scanned, and starts anew beyond ``DICTIONARY`` words. Long texts are scanned in
pieces; their runs are composed over all of a text's payloads.
"""

from __future__ import annotations

import math
import zlib
from functools import cache
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ALNUM, written

#: Words that a task's automaton holds at most before it is built anew.
DICTIONARY = 100_000
#: Bytes of text learned and scanned together; words whose runs are composed together.
GROUP, BLOCK = 2 << 20, 1 << 19


@cache
def _moves() -> list[np.ndarray]:
    """Tables that move a CRC on by 1, 2, 4, ... zero bytes, one byte of the CRC at a time."""
    zero = zlib.crc32(b"\0", 0)
    tables = [np.array([[zlib.crc32(b"\0", v << 8 * b) ^ zero for v in range(256)] for b in range(4)], dtype=np.uint32)]
    while len(tables) < 32:
        tables.append(moved_once(tables[-1], tables[-1]))
    return tables


def moved_once(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 255] ^ table[1][crc >> 8 & 255] ^ table[2][crc >> 16 & 255] ^ table[3][crc >> 24]


def moved(crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRCs after ``lengths`` more bytes, but for the CRC of those bytes themselves."""
    out = crc.copy()
    for k in range(int(lengths.max(initial=0)).bit_length()):
        on = np.flatnonzero(lengths >> k & 1)
        out[on] = moved_once(_moves()[k], out[on])
    return out


class Words:
    """The automaton of the words met so far, and their payloads: CRC of the word, CRC of
    blank and word, length of both."""

    def __init__(self) -> None:
        self.automaton, self.known = ahocorasick.Automaton(ahocorasick.STORE_INTS), set()
        self.payload: list[tuple[int, int, int]] = []
        self.table = np.zeros((0, 3), dtype=np.uint32)

    def learn(self, words: set[str]) -> None:
        new = words - self.known
        if not new:
            return
        if self.known and len(self.known) + len(new) > DICTIONARY:
            self.__init__()
            new = words
        for w in new:
            raw = w.encode("latin-1")
            self.automaton.add_word(f" {w} ", len(self.payload))
            self.payload.append((zlib.crc32(raw), zlib.crc32(b" " + raw), len(raw) + 1))
        self.automaton.make_automaton()
        self.known |= new
        self.table = np.array(self.payload, dtype=np.uint32)

    def scan(self, text: str) -> np.ndarray:
        """A row of payload for each word of ``text``, which starts and ends with a blank."""
        return self.table[np.fromiter(map(itemgetter(1), self.automaton.iter(text)), dtype=np.int64)]


def plain(raw: bytes | None) -> str:
    """The words of a text between blanks, one character a byte."""
    return f" {(raw or b'').translate(ALNUM).decode('latin-1')} "


def pieces(text: str) -> list[str]:
    """Parts of about ``GROUP`` characters, cut at blanks, which both parts keep."""
    out, at = [], 0
    while (cut := text.find(" ", at + GROUP)) >= 0 and cut < len(text) - 1:
        out.append(text[at: cut + 1])
        at = cut
    return [*out, text[at:]]


def payloads(words: Words, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The payloads of all words of ``texts`` and the number of words of each."""
    counts, rows = np.zeros(len(texts), dtype=np.int64), [words.table[:0]]
    parts = [(k, part) for k, text in enumerate(texts) for part in pieces(text)]
    while parts:
        size, n = 0, 0
        while n < len(parts) and size < GROUP:
            size, n = size + len(parts[n][1]), n + 1
        met = set().union(*(part.split(" ") for _, part in parts[:n])) - {""}
        words.learn(met)
        for k, part in parts[:n] if met else ():
            rows.append(words.scan(part))
            counts[k] += len(rows[-1])
        parts = parts[n:]
    return np.concatenate(rows), counts


def composed(payload: np.ndarray, counts: np.ndarray, max_run: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the runs of each text, text after text, and their number for each text."""
    n, kind = len(payload), np.uint16 if buckets <= 1 << 16 else np.uint32
    last = np.repeat(np.cumsum(counts), counts)
    out = [np.zeros(0, dtype=kind)]
    for lo in range(0, n, BLOCK):
        crc = payload[lo: lo + BLOCK, 0]
        values, there = np.zeros((len(crc), max_run), dtype=kind), np.zeros((len(crc), max_run), dtype=bool)
        for k in range(max_run):
            if k:
                added = payload[lo + k: lo + BLOCK + k]
                crc = moved(crc[: len(added)], added[:, 2]) ^ added[:, 1]
            values[: len(crc), k] = crc % np.uint32(buckets)
            there[: len(crc), k] = np.arange(lo + k, lo + k + len(crc)) < last[lo: lo + len(crc)]
        out.append(values[there])
    return np.concatenate(out), np.sum([np.maximum(counts - k, 0) for k in range(max_run)], axis=0)


def scanned(max_run: int, buckets: int):
    def batches(it):
        words = Words()
        for batch in it:
            texts, size = [], 0
            at = 0
            for k in range(batch.num_rows):
                texts.append(plain(batch.column(1)[k].as_py()))
                size += len(texts[-1])
                if size >= GROUP or k + 1 == batch.num_rows:
                    values, counts = composed(*payloads(words, texts), max_run, buckets)
                    ends = np.concatenate([[0], np.cumsum(counts * values.itemsize)])
                    found = pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(values)])
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(counts, pa.int64()), found.cast(pa.binary())],
                                                     ["doc_id", "n_features", "buckets"])
                    at, texts, size = k + 1, [], 0
    return batches


def _values(column: pa.Array, buckets: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16 if buckets <= 1 << 16 else np.uint32)


def counted(buckets: int):
    def batches(it):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in it:
            total += np.bincount(_values(batch.column(0), buckets), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], ["bucket", "n"])
    return batches


def weighed(gains: list[int]):
    gain = np.array(gains, dtype=np.int64)

    def batches(it):
        for batch in it:
            n = batch.column(1).to_numpy()
            upto = np.concatenate([[0], np.cumsum(gain[_values(batch.column(2), len(gain))])])
            ends = np.cumsum(n)
            weight = np.floor_divide(upto[ends] - upto[ends - n], np.maximum(n, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(weight, pa.int64())], ["doc_id", "n_features", "weight"])
    return batches


def bucket_gains(target: list[int], documents: list[int]) -> list[int]:
    """floor(1000 ln) of each bucket's smoothed share in the target over its share in the documents."""
    more, t_all, s_all = float(len(target)), float(sum(target)), float(sum(documents))
    return [math.floor(1000 * math.log((t + 1.0) * (s_all + more) / ((s + 1.0) * (t_all + more)))) for t, s in zip(target, documents)]


def _counts(found: DataFrame, buckets: int) -> list[int]:
    out = [0] * buckets
    counted_rows = found.select("buckets").mapInArrow(counted(buckets), "bucket int, n long")
    for row in counted_rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most `buckets` rows
        out[row.bucket] = row.n
    return out


def importance_resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
                        max_run: int = 2, buckets: int = 10_000, share: tuple[int, int] = (25, 100), min_words: int = 20,
                        seed: int = 7) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_features``, ``weight``, ``score`` and
    ``rank`` (1, 2, 3, ... of the drawn, null for the others).

    Words are runs of digits, letters and bytes beyond ASCII after lower-casing A-Z;
    features are the runs of 1 to ``max_run`` neighbouring words. Of the documents with at
    least ``min_words`` words, the given share (rounded down) with the highest scores is
    drawn, ties to the smaller identifier, then to any of the rows repeated with it. Null
    and empty texts, and texts without words, have no features, weight 0 and are not drawn
    unless ``min_words`` is 0. A null identifier draws noise as an empty one does and ranks
    after others of its score. Very long texts are scanned in pieces; a task holds 12 bytes
    a word of the longest one. Further columns are ignored; an empty table gives an empty
    result, an empty target leaves every bucket its smoothing.
    """
    scan = scanned(max_run, buckets)
    schema = "doc_id long, n_features long, buckets binary"
    found = written(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
                    .mapInArrow(scan, schema), "buckets")
    aims = target.select(F.lit(0).cast("long").alias("doc_id"), F.col(target_col).cast("binary").alias("text")).mapInArrow(scan, schema)
    gains = bucket_gains(_counts(aims, buckets), _counts(found, buckets))
    fewest = sum(max(min_words - k, 0) for k in range(max_run))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    noise = F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0)))
    scored = written(found.mapInArrow(weighed(gains), "doc_id long, n_features long, weight long")
                     .withColumn("score", F.col("weight") + noise).withColumn("open", F.col("n_features") >= fewest).withColumn("row", F.monotonically_increasing_id()), "scored")
    n_open = scored.where("open").count()
    return ranked(scored, n_open * share[0] // share[1]).select("doc_id", "n_features", "weight", "score", "rank")


def ranked(scored: DataFrame, n_drawn: int) -> DataFrame:
    """``scored`` with ``rank`` over the open rows, null beyond ``n_drawn``.

    Rows are dealt into ranges of the order and sorted there; a row's rank is its place in
    its range and the rows of the ranges before it. Only counts per range meet in one place.
    """
    order = [F.desc("open"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    place = F.monotonically_increasing_id()
    dealt = written(scored.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", place), "ranges").withColumn("part", F.shiftright("place", 33))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(dealt.groupBy("part").agg(F.count("*").alias("n"), F.min("place").alias("first"))
                     .withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))), "range-starts")
    rank = F.col("start") + F.col("place") - F.col("first") + 1
    return dealt.join(starts, "part").withColumn("rank", F.when(F.col("open") & (rank <= n_drawn), rank))

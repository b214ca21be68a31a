"""Suffix-array dedup: bytes covered by long strings that occur more than once.

A string of ``min_bytes`` bytes is a window. Every window has one anchor, the leftmost
smallest hashed 8-gram among its first ``SPAN`` positions, which its bytes alone decide. So
equal windows have equal anchors, and only suffixes at anchors need sorting: about one
position in a hundred. A record is an anchor's suffix, with the bytes to its left that its
windows start in.

1. Anchors are counted by a hash of the bytes that all windows of an anchor share. Records
   whose hash occurs once can't repeat and never leave their task. A hash that very many
   records have (boilerplate shorter than a window, in ever different surroundings) is hot:
   its records are split by how far from the anchor their windows start, in classes of
   ``WIDTHS`` starts, whose windows share a longer stretch, and counted by the hash of that.
   Classes of one start share the whole window, so that what is hot then does repeat, and
   its equal records are one in each task.
2. The other records are sorted in each task into runs by (hash, suffix). Records that are
   equal in a run are found out at once and go on as one. Runs are front-coded, cut by hash
   range and exchanged.
3. Each range is merged by a loser tree that knows how much of each head agrees with the
   last winner and compares from there on. The merged order's common prefixes, together
   with those of the left contexts of neighbouring records, say which windows repeat.

Window starts that repeat come back to their documents as intervals.
"""

from __future__ import annotations

import hashlib
import struct
from bisect import bisect_left
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

SPAN, GRAM = 256, 8
#: Texts are scanned in segments and groups of segments of up to so many bytes.
SEGMENT = 1 << 20
#: Window starts in a class of a hot hash's records, and in one of a class that is hot again.
WIDTHS = (16, 1)
#: Bytes of records that a task sorts into one run.
RUN_BYTES = 24 << 20
_RNG = np.random.default_rng(20)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)


@lru_cache(maxsize=2)
def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint64)
    p[0] = 1
    return np.cumprod(p)


def powers(base: np.uint64, n: int) -> np.ndarray:
    return _powers(int(base), 1 << max(21, int(n).bit_length()))[:n]


class Fingerprints:
    """Hashes of any stretch of a byte array, equal for equal bytes wherever they stand."""

    def __init__(self, a: np.ndarray):
        self.sums = np.zeros(len(a) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[a] * powers(_BASE, len(a)), out=self.sums[1:])

    def of(self, start: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        h = (self.sums[start + length] - self.sums[start]) * powers(_INVERSE, len(self.sums))[start]
        h ^= h >> np.uint64(29)
        h *= _MIX
        return h ^ (h >> np.uint64(32))


def anchors(a: np.ndarray, starts: np.ndarray, ends: np.ndarray, min_bytes: int):
    """Of texts a[start:end] in one array: first and last window start and anchor of each
    record, and the hash of what its windows share."""
    none = (np.zeros(0, dtype=np.int64),) * 3 + (np.zeros(0, dtype=np.uint64),)
    n = ends - starts - min_bytes + 1
    long = n > 0
    if not long.any():
        return none
    starts, n = starts[long], n[long]
    p = np.repeat(starts - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
    g = a.astype(np.uint64)
    g = g[:-1] | g[1:] << np.uint64(8)
    g = g[:-2] | g[2:] << np.uint64(16)
    g = g[:-4] | g[4:] << np.uint64(32)
    g *= _BASE
    g ^= g >> np.uint64(31)
    g *= _MIX
    g >>= np.uint64(32)
    g <<= np.uint64(32)
    g |= np.arange(len(g), dtype=np.uint64)
    padded = np.full(-(-len(g) // SPAN) * SPAN, np.iinfo(np.uint64).max)
    padded[: len(g)] = g
    blocks = padded.reshape(-1, SPAN)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    at = (np.minimum(behind[p], ahead[p + SPAN - 1]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (p[1:] != p[:-1] + 1))))
    last = np.concatenate((first[1:], [len(p)])) - 1
    anchor = at[first]
    return p[first], p[last], anchor, Fingerprints(a).of(anchor, min_bytes - SPAN + 1)


def segments(batch: pa.RecordBatch, min_bytes: int):
    """Groups of (index in the batch, offset, bytes); a long text's segments overlap, so
    that each window start belongs to one of them."""
    group, size = [], 0
    for k, text in enumerate(batch.column("text")):
        raw = text.as_py() or b""
        for at in range(0, max(1, len(raw) - min_bytes + 1), SEGMENT):
            part = raw[at: at + SEGMENT + min_bytes - 1]
            if len(part) < min_bytes:
                continue
            if group and size + len(part) > SEGMENT:
                yield group
                group, size = [], 0
            group.append((k, at, part))
            size += len(part)
    if group:
        yield group


def scanned(group: list, min_bytes: int):
    """(joined bytes, start of each segment, first, last, anchor, hash, segment) of a group."""
    raw = b"".join(g[2] for g in group) + bytes(SPAN + GRAM)
    ends = np.cumsum([len(g[2]) for g in group])
    starts = np.concatenate(([0], ends[:-1]))
    first, last, anchor, h = anchors(np.frombuffer(raw, dtype=np.uint8), starts, ends, min_bytes)
    return raw, starts, first, last, anchor, h, np.searchsorted(starts, first, side="right") - 1


def member(keys: np.ndarray, seg: np.ndarray, group: list, of: list[np.ndarray]) -> np.ndarray:
    """Whether each key is in the sorted keys ``of`` its row; ``seg``, in order, tells the
    segment, and that the row."""
    out = np.zeros(len(keys), dtype=bool)
    bounds = np.searchsorted(seg, np.arange(len(group) + 1))
    for s, g in enumerate(group):
        want, part = of[g[0]], keys[bounds[s]: bounds[s + 1]]
        if len(want) and len(part):
            out[bounds[s]: bounds[s + 1]] = want[np.minimum(np.searchsorted(want, part), len(want) - 1)] == part
    return out


def classes(prints: Fingerprints, first, last, anchor, width: int, min_bytes: int):
    """Records split by the distance of their window starts from the anchor: the record that
    each is of, its first and last start, and the hash of what its windows share."""
    low = (anchor - last) // width
    n = (anchor - first) // width - low + 1
    of = np.repeat(np.arange(len(first)), n)
    c = low[of] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    near = anchor[of] - c * width
    key = prints.of(near, min_bytes - width + 1) ^ (c.astype(np.uint64) * np.uint64(SPAN) + np.uint64(width)) * _BASE
    key ^= key >> np.uint64(31)
    return of, np.maximum(first[of], near - width + 1), np.minimum(last[of], near), key * _MIX


def split_hot(raw: bytes, group: list, first, last, anchor, h, seg, hot: list[np.ndarray], min_bytes: int, levels: int):
    """The records with those of hot keys split, level by level; and which are of the last level."""
    level = np.zeros(len(h), dtype=np.int64)
    if any(len(hot[g[0]]) for g in group):
        prints = Fingerprints(np.frombuffer(raw, dtype=np.uint8))
        for k, width in enumerate(WIDTHS[:levels], 1):
            crowded = member(h, seg, group, hot) & (level == k - 1)
            if not crowded.any():
                break
            at, rest = np.flatnonzero(crowded), np.flatnonzero(~crowded)
            of, p, q, key = classes(prints, first[at], last[at], anchor[at], width, min_bytes)
            parts = [(first, p), (last, q), (anchor, anchor[at][of]), (h, key), (seg, seg[at][of]), (level, np.full(len(of), k))]
            first, last, anchor, h, seg, level = (np.concatenate((x[rest], new)) for x, new in parts)
            order = np.lexsort((first, seg))
            first, last, anchor, h, seg, level = (x[order] for x in (first, last, anchor, h, seg, level))
    return first, last, anchor, h, seg, level


def _keys(column) -> list[np.ndarray]:
    return [np.sort(np.array(x.as_py() or [], dtype=np.int64).view(np.uint64)) for x in column]


def hashes(min_bytes: int, level: int = 0):
    """Keys (doc, row, h) of the records, and a hash ``r`` of all bytes of each; of the given
    level of hot keys where it is not 0."""
    def batches(it):
        for batch in it:
            hot = _keys(batch.column("hot")) if level else None
            for group in segments(batch, min_bytes):
                raw, _, first, last, anchor, h, seg = scanned(group, min_bytes)
                if level:
                    *found, at_level = split_hot(raw, group, first, last, anchor, h, seg, hot, min_bytes, level)
                    first, last, anchor, h, seg = (x[at_level == level] for x in found)
                r = Fingerprints(np.frombuffer(raw, dtype=np.uint8)).of(first, last - first + min_bytes) ^ (anchor - first).astype(np.uint64) * _BASE
                at = pa.array(np.array([g[0] for g in group])[seg]) if len(h) else pa.array([], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("doc").take(at), batch.column("row").take(at),
                                                  pa.array(h.view(np.int64)), pa.array(r.view(np.int64))], ["doc", "row", "h", "r"])
    return batches


def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes are known."""
    n = min(len(a), len(b))
    for stop in (min(known + 16, n), n):
        if a[known:stop] != b[known:stop]:
            x = int.from_bytes(a[known:stop], "big") ^ int.from_bytes(b[known:stop], "big")
            return stop - (x.bit_length() + 7) // 8
        known = stop
    return n


_HEAD = struct.Struct("<HHHHHqqi")


def front_coded(records: list) -> bytes:
    """Sorted records (suffix, left, windows, doc, row, first) with the part that each
    shares with the one before left out. ``windows``: the number of window starts; row
    identity and place are those to report to, and place -1 asks for no report."""
    out, suffix, left = [], b"", b""
    for s, l, windows, doc, row, first in records:
        same = common(s, suffix, 0)
        back = common(l, left, 0)
        out += [_HEAD.pack(same, len(s) - same, back, len(l) - back, windows, doc, row, first), s[same:], l[back:]]
        suffix, left = s, l
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def decoded(blob: bytes):
    """Records of a run with their common prefix with the record before."""
    raw = zstandard.ZstdDecompressor().decompress(blob, max_output_size=1 << 31)
    at, suffix, left, out = 0, b"", b"", []
    while at < len(raw):
        same, n, back, m, windows, doc, row, first = _HEAD.unpack_from(raw, at)
        at += _HEAD.size
        suffix = suffix[:same] + raw[at: at + n]
        left = left[:back] + raw[at + n: at + n + m]
        at += n + m
        out.append((same, suffix, left, windows, doc, row, first))
    return out


def merged(runs: list[list]) -> list:
    """One sorted run of several: (common prefix with the record before, suffix, ...).

    A loser tree. Every waiting head carries the length of its common prefix with the last
    record that passed its node; of two heads that share a different length with it, the
    longer one is smaller, and only equal lengths call for bytes, from that length on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    heads: list = [iter(r) for r in runs] + [iter(())] * (k - len(runs))
    current = [next(h, None) for h in heads]
    lcp = [0] * k
    losers = [0] * k

    def beats(i: int, j: int) -> bool:
        """Whether head i goes before head j; the later one's common prefix becomes that with the earlier."""
        a, b = current[i], current[j]
        if a is None or b is None:
            return b is None
        if lcp[i] != lcp[j]:
            return lcp[i] > lcp[j]
        n = common(a[1], b[1], lcp[i])
        first = n == len(a[1]) or n < len(b[1]) and a[1][n] < b[1][n]
        lcp[j if first else i] = n
        return first

    def build(node: int) -> int:
        if node >= k:
            return node - k
        i, j = build(2 * node), build(2 * node + 1)
        won, lost = (i, j) if beats(i, j) else (j, i)
        losers[node] = lost
        return won

    out = []
    won = build(1)
    while current[won] is not None:
        out.append((lcp[won], *current[won][1:]))
        current[won] = head = next(heads[won], None)
        lcp[won] = head[0] if head else 0
        node = (won + k) // 2
        while node:
            other = losers[node]
            if beats(other, won):
                losers[node], won = won, other
            node //= 2
    return out


def make_runs(min_bytes: int, ranges_log2: int):
    """Rows (range, run, doc, row, starts, stops): front-coded runs by range of the hash,
    and window starts that a task found repeated by itself."""
    names = ["range", "run", "doc", "row", "starts", "stops"]
    kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))

    def flushed(held: dict, repeated: dict):
        order, parts = sorted(held.items(), key=lambda r: r[0][0]), {}
        for (suffix, left), place in order:
            parts.setdefault(suffix[0] << 8 | suffix[1], []).append((suffix, left, *place))
        cut: dict = {}
        for top, records in parts.items():
            cut.setdefault(top >> 16 - ranges_log2, []).extend(records)
        rows = [[r, front_coded(x), None, None, None, None] for r, x in cut.items()]
        for (doc, row), spans in repeated.items():
            rows.append([None, None, doc, row, [s for s, _ in spans], [s for _, s in spans]])
        for at in range(0, len(rows), 64):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at: at + 64]), kinds)], names)

    def batches(it):
        held, repeated, size = {}, {}, 0
        for batch in it:
            docs, rows = batch.column("doc").to_pylist(), batch.column("row").to_pylist()
            wanted, hot = _keys(batch.column("hs")), _keys(batch.column("hot"))
            for group in segments(batch, min_bytes):
                raw, starts, first, last, anchor, h, seg = scanned(group, min_bytes)
                first, last, anchor, h, seg, _ = split_hot(raw, group, first, last, anchor, h, seg, hot, min_bytes, len(WIDTHS))
                k = np.flatnonzero(member(h, seg, group, wanted))
                for p, q, a, x, s in zip(first[k].tolist(), last[k].tolist(), anchor[k].tolist(), h[k].tolist(), seg[k].tolist()):
                    b, offset, _ = group[s]
                    at = p - int(starts[s]) + offset
                    place = (q - p + 1, docs[b], rows[b], at)
                    key = (x.to_bytes(8, "big") + raw[a: q + min_bytes], raw[p:a][::-1])
                    if (old := held.get(key)) is None:
                        held[key] = place
                        size += len(key[0]) + len(key[1])
                        continue
                    for n, doc, row, at in [place] + [old] * (old[3] >= 0):
                        spans = repeated.setdefault((doc, row), [])
                        if spans and spans[-1][1] == at - 1:
                            spans[-1] = (spans[-1][0], at + n - 1)
                        else:
                            spans.append((at, at + n - 1))
                    held[key] = (place[0], 0, 0, -1)
                if size >= RUN_BYTES:
                    yield from flushed(held, repeated)
                    held, repeated, size = {}, {}, 0
        yield from flushed(held, repeated)
    return batches


def agreeing(records: list, min_bytes: int) -> list[list[tuple[int, int]]]:
    """For each record of a merged run, how far left of the anchor its repeated windows
    start: intervals [lo, hi] of bytes.

    A window that starts d bytes left of the anchor repeats if another record agrees with
    this one for ``min_bytes`` - d bytes from the anchor on and for d bytes before it. The
    merge has told how far neighbours agree from the anchor on. Going from the longest of
    these common prefixes to the shortest, groups of neighbours that agree so far are joined;
    a group keeps its left contexts in order, so that the one a record agrees with longest to
    the left is its neighbour there. The smaller group goes into the larger one, and only
    neighbours of what is put in can change.
    """
    best, spans = [-1] * len(records), [[] for _ in records]
    lists = [[(r[2], k)] for k, r in enumerate(records)]
    low, high = list(range(len(records))), list(range(len(records)))  # of the group that ends, or begins, here
    reach = [r[0] - 8 for r in records]  # the merged bytes begin with the hash

    def meets(k: int, same: int, agreed: int) -> None:
        if same > best[k]:
            best[k], least = same, max(0, min_bytes - agreed)
            if same >= least:
                spans[k].append((least, same))

    near = [k for k in range(1, len(records)) if reach[k] > min_bytes - SPAN]
    for k in sorted(near, key=lambda k: -reach[k]):
        first, last = low[k - 1], high[k]
        one, other = lists[first], lists[k]
        into, put = (one, other) if len(one) >= len(other) else (other, one)
        for left, r in put:
            at = bisect_left(into, (left, r))
            for beside in into[max(0, at - 1): at + 1]:
                same = common(left, beside[0], 0)
                meets(r, same, reach[k])
                meets(beside[1], same, reach[k])
            into.insert(at, (left, r))
        lists[first], lists[k] = into, []
        low[last], high[first] = first, last
    return spans


def repeats(min_bytes: int):
    """The window starts of one hash range that repeat, by document, as the merged order of
    its runs tells them."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        records = merged([decoded(b) for b in group["run"]])
        found: dict = {}
        for (_, _, left, n, doc, row, first), spans in zip(records, agreeing(records, min_bytes)):
            if first < 0:  # equal records of a task are one and have been reported there
                continue
            for lo, hi in spans:
                a, b = max(0, len(left) - hi), min(n - 1, len(left) - lo)
                if a <= b:
                    starts, stops = found.setdefault((doc, row), ([], []))
                    starts.append(first + a)
                    stops.append(first + b)
        lists = list(found.values())  # as objects, also where there are none
        return pd.DataFrame({"doc": pd.Series([d for d, _ in found], dtype="int64"), "row": pd.Series([r for _, r in found], dtype="int64"),
                             "starts": pd.Series([s for s, _ in lists], dtype=object), "stops": pd.Series([t for _, t in lists], dtype=object)})
    return run


def cut_text(raw: bytes, starts: list, stops: list, min_bytes: int) -> tuple[list[tuple[int, int]], bytes]:
    """Maximal removed runs of a text, and what is left of it."""
    runs: list = []
    for a, b in sorted(zip(starts, stops)):
        b += min_bytes
        if runs and a <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(b, runs[-1][1]))
        else:
            runs.append((a, b))
    kept, at = [], 0
    for a, b in runs:
        kept.append(raw[at:a])
        at = b
    return runs, b"".join(kept) + raw[at:]


def cut_texts(min_bytes: int):
    def batches(it):
        for batch in it:
            out: list = [[], [], [], [], []]
            for text, starts, stops in zip(batch.column("text"), batch.column("starts").to_pylist(), batch.column("stops").to_pylist()):
                raw = text.as_py() or b""
                runs, kept = cut_text(raw, starts or [], stops or [], min_bytes)
                for column, value in zip(out, (len(raw), len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), [list(r) for r in runs])):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *[pa.array(c, t) for c, t in zip(out, kinds)]],
                                             ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])
    return batches


def counted(seen: DataFrame, hot_records: int, name: str) -> DataFrame:
    """The hashes ``h`` that repeat, with ``n``: how many records have them or, where those
    are many, how many different ones. Equal records are one in each task, so that a passage
    repeated as it is in very many documents is not hot."""
    often = written(seen.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), name)
    many = often.where(F.col("n") > hot_records).select("h")
    if many.isEmpty():
        return often
    unlike = seen.join(many, "h").select("h", "r").distinct().groupBy("h").agg(F.count("*").alias("unlike"))
    unlike = written(unlike, f"{name}-unlike")
    return often.join(unlike, "h", "left").select("h", F.coalesce("unlike", "n").alias("n"))


def wanted_keys(texts: DataFrame, min_bytes: int, hot_records: int) -> DataFrame:
    """Per text (doc, row): the keys ``hs`` of its records that may repeat, the ``hot`` keys
    that led to some of them, and ``n``, the number of its records."""
    seen = written(texts.where(F.octet_length("text") >= min_bytes).mapInArrow(hashes(min_bytes), "doc long, row long, h long, r long"), "anchors")
    often = counted(seen, hot_records, "repeated-anchors")
    wanted, hot = seen.join(often.where(F.col("n") <= hot_records).select("h"), "h").select("doc", "row", "h", F.lit(False).alias("hot")), []
    for level in range(1, len(WIDTHS) + 1):
        crowded = seen.join(often.where(F.col("n") > hot_records).select("h"), "h").select("doc", "row", "h").distinct()
        crowded = written(crowded, "hot-anchors")
        if crowded.isEmpty():
            break
        hot.append(crowded)
        so_far = hot[0] if len(hot) == 1 else hot[0].unionByName(hot[1])
        of = written(so_far.groupBy("doc", "row").agg(F.collect_set("h").alias("hot")), "hot-rows")
        seen = written(texts.join(of.hint("merge"), ["doc", "row"]).mapInArrow(hashes(min_bytes, level), "doc long, row long, h long, r long"), "classes")
        often = counted(seen, hot_records, "repeated-classes")
        most = F.col("n") <= hot_records if level < len(WIDTHS) else F.lit(True)
        wanted = wanted.unionByName(seen.join(often.where(most).select("h"), "h").select("doc", "row", "h", F.lit(False).alias("hot")))
    for keys in hot:
        wanted = wanted.unionByName(keys.select("doc", "row", "h", F.lit(True).alias("hot")))
    key = F.when(F.col("hot"), F.col("h"))
    return (wanted.groupBy("doc", "row").agg(F.collect_set(F.when(~F.col("hot"), F.col("h"))).alias("hs"), F.collect_set(key).alias("hot"),
                                             F.count_if(~F.col("hot")).alias("n")).where("n > 0"))


def dedup_substrings(docs: DataFrame, min_bytes: int = 400, id_col: str = "doc_id", text_col: str = "text",
                     range_records: int = 12_000, hot_records: int = 100_000) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``n_removed``, ``n_spans``,
    ``kept_sha256`` and ``spans`` (the removed runs, as [start, end) bytes of the text).

    Removed is each byte covered by a string of ``min_bytes`` bytes that starts anywhere
    else too, in this or another row; overlaps count, and all strings are judged on the
    input. Null texts count as empty; texts shorter than ``min_bytes`` stay whole. Repeated
    rows, with or without the same identifier, are copies of each other like any others.
    Very long texts are read in overlapping segments. Records of a hash that more than
    ``hot_records`` unlike records have (of at most 655 bytes for strings of 400: 65 MB) are
    split, and those of a hash range, ``range_records`` on average, meet in one task.
    Further columns are ignored; an empty table gives an empty result. ``min_bytes`` must
    exceed 264 (the anchors' span and gram).
    """
    if min_bytes < SPAN + GRAM:
        raise ValueError(f"min_bytes must be at least {SPAN + GRAM}")
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("doc")
    row = F.xxhash64(F.col(id_col), F.col(text_col)).alias("row")
    texts = docs.select(doc, row, F.col(text_col).cast("binary").alias("text"))
    wanted = written(wanted_keys(texts, min_bytes, hot_records), "wanted")
    total = wanted.agg(F.sum("n")).first()[0] or 0
    log2 = min(16, max(0, int(total // range_records).bit_length()))
    runs = written(texts.join(wanted.drop("n").hint("merge"), ["doc", "row"])
                   .mapInArrow(make_runs(min_bytes, log2), "range long, run binary, doc long, row long, starts array<long>, stops array<long>"), "runs")
    spans = "doc long, row long, starts array<long>, stops array<long>"
    across = runs.where("run IS NOT NULL").select("range", "run").groupBy("range").applyInPandas(repeats(min_bytes), spans)
    inside = runs.where("run IS NULL").select("doc", "row", "starts", "stops")
    cuts = written(inside.unionByName(across).groupBy("doc", "row").agg(F.flatten(F.collect_list("starts")).alias("starts"),
                                                                        F.flatten(F.collect_list("stops")).alias("stops")), "spans")
    whole = docs.select(F.col(id_col).cast("long").alias("id"), doc, row, F.col(text_col).cast("binary").alias("text"))
    return (whole.join(cuts.hint("merge"), ["doc", "row"], "left").select("id", "text", "starts", "stops")
            .mapInArrow(cut_texts(min_bytes), "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>")
            .withColumnRenamed("id", id_col))

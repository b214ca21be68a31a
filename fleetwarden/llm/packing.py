"""Best-fit packing with large-item matching.

Documents become token pieces of at most the capacity. How pieces share sequences depends
on their lengths alone, so the plan is made from the histogram of lengths: at most one row
per length up to the capacity, however many documents there are. In the plan, pieces above
one third of the capacity go at most two to a sequence, the longest first with the longest
partner that still fits; shorter ones follow, longest first, each to the sequence with the
smallest gap that holds it. Whole batches of equal lengths are placed at once.

Each placement says: the pieces ranked r to r + n - 1 among those of their length go to the
sequences s to s + n - 1, at one offset. Pieces are ranked by a distributed numbering and
find their placement by a join on length and rank.
"""

from __future__ import annotations

import bisect
import os
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, written

#: At most so many chunks are remembered by a worker, none longer than CACHED_CHARS.
CACHED_CHUNKS, CACHED_CHARS = 1_000_000, 40
#: Texts are encoded together up to so many characters, unknown chunks in lines of LINE.
SLICE, LINE = 2_000_000, 256
#: ASCII punctuation but for the apostrophe, which can start a token with letters after it.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

PIECES = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Memory(dict):
    """Ids of chunks; of one that it lacks, what ``encode`` gives."""

    def __init__(self, encode):
        super().__init__({"": b""})
        self.encode = encode

    def __missing__(self, chunk: str) -> bytes | None:
        return self.encode(chunk)


def byte_chars(text: str) -> str:
    """The text's UTF-8 bytes as the characters that stand for them in byte-level vocabularies."""
    from tokenizers.pre_tokenizers import ByteLevel
    return "".join(x for x, _ in ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(text))


class Words:
    """Ids of texts as little-endian unsigned 32-bit bytes, with a memory of chunks.

    The vocabulary drops white space, joins nothing across it and ignores case, so a
    text's ids are those of its blank-separated chunks. Special tokens are found in the text
    as it is, before case is ignored, and are chunks of their own. Each chunk that is not
    remembered is encoded without the punctuation at its end, which makes tokens of its own
    after a letter or digit and is the same few strings again and again. What is left may be
    remembered itself. If not, it is one word for the tokenizer's model if it is of lower-case
    Latin-1 letters alone; anything else waits for the end of the slice and goes through the
    whole tokenizer, many at once; the offsets of the tokens tell whose they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        if hasattr(self.model, "_resize_cache"):  # it is asked for words that are not remembered: none twice
            self.model._resize_cache(0)
        special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        #: What all special tokens start with: a text without it needs no search for them.
        self.mark = os.path.commonprefix(special)
        self.specials = frozenset(special)
        #: Whether the vocabulary keeps lower-case words whole, as given, and parts them from punctuation.
        self.whole = all(self.tok.encode(w + m, add_special_tokens=False).ids == self.word(w) + self.word(m)
                         for w in ("a", "the", "word", "internationalised", "qzxjk") for m in ("", ".", ",$$$"))
        #: Lower-case letters beyond ASCII as the model takes their bytes, if it does so one by one.
        self.letters = {ord(c): byte_chars(c) for c in map(chr, range(128, 256)) if c.isalpha() and c.islower()}
        if any(self.tok.encode(x, add_special_tokens=False).ids != self.word(x) for c in map(chr, self.letters) for x in (c, f"a{c}e", f"{c}{c}")):
            self.letters = {}
        self.special = re.compile("(" + ("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or "(?!)") + ")")
        self.known = Memory(self.encode)
        #: Ids of this slice's chunks that are too long or too many to be remembered, and the chunks that wait.
        self.passing: dict[str, bytes] = {}
        self.waiting: dict[str, None] = {}

    def chunks(self, text: str) -> list[str]:
        out = []
        for k, part in enumerate(self.special.split(text) if self.mark in text else (text,)):
            if k % 2:
                out.append(part)
                continue
            try:  # within Latin-1 lower-casing is letter by letter, as the vocabulary does it
                part.encode("latin-1")
                low = part.lower()
                if self.mark not in low or not self.special.search(low):  # a special token in capitals is none
                    part = low
            except UnicodeEncodeError:
                pass
            out += part.replace("\n", " ").split(" ")
        return out

    def word(self, text: str) -> list[int]:
        return [t.id for t in self.model.tokenize(text if text.isascii() else text.translate(self.letters))]

    def one_word(self, chunk: str) -> bool:
        if not (self.whole and chunk.isalpha() and chunk.islower()):
            return False
        return chunk.isascii() or bool(self.letters) and max(chunk) <= "\u00ff"

    def stem(self, chunk: str) -> str:
        """The chunk without the punctuation at its end, where that can be encoded apart."""
        stem = chunk.rstrip(MARKS)
        if len(stem) == len(chunk) or not self.whole or chunk in self.specials or not stem or stem[-1] > "\u00ff" or not (stem[-1].isalpha() or "0" <= stem[-1] <= "9"):
            return chunk
        return stem

    def encode(self, chunk: str) -> bytes | None:
        """Ids of a chunk that is not remembered; none if it waits for the whole tokenizer."""
        if chunk in self.passing:
            return self.passing[chunk]
        stem = self.stem(chunk)
        if len(stem) < len(chunk):
            met = stem in self.known or stem in self.passing
            ids, end = self.known[stem], self.known[chunk[len(stem):]]
            if ids is None or end is None:
                return None
            ids += end
            if not met:  # rare so far: the stem alone is worth remembering
                return ids
        elif self.one_word(chunk):
            ids = b"".join([k.to_bytes(4, "little") for k in self.word(chunk)])
        else:
            self.waiting[chunk] = None
            return None
        self.remember(chunk, ids)
        return ids

    def remember(self, chunk: str, ids: bytes) -> None:
        kept = len(chunk) <= CACHED_CHARS and len(self.known) < CACHED_CHUNKS
        (self.known if kept else self.passing)[chunk] = ids

    def encode_lines(self, chunks: list[str]) -> dict[str, bytes]:
        lines = [chunks[k: k + LINE] for k in range(0, len(chunks), LINE)]
        out: dict[str, bytes] = {}
        for line, found in zip(lines, self.tok.encode_batch([" ".join(x) for x in lines], add_special_tokens=False)):
            ends = np.cumsum([len(x) + 1 for x in line])
            ids = np.array(found.ids, dtype="<u4")
            at = np.array([a for a, _ in found.offsets], dtype=np.int64)
            cuts = np.searchsorted(at, ends).tolist()
            raw, before = ids.tobytes(), 0
            for chunk, cut in zip(line, cuts):
                out[chunk] = raw[4 * before: 4 * cut]
                before = cut
        return out

    def ids(self, texts: list[str]) -> list[bytes]:
        parts, out = [self.chunks(t) for t in texts], []
        look = self.known.__getitem__
        found = [list(map(look, part)) for part in parts]
        for chunk, ids in self.encode_lines(list(self.waiting)).items():
            self.remember(chunk, ids)
        self.waiting.clear()
        for part, ids in zip(parts, found):
            try:
                out.append(b"".join(ids))
            except TypeError:  # a chunk of it had to wait
                out.append(b"".join(map(look, part)))
        self.passing.clear()
        return out


@lru_cache(maxsize=2)
def words_of(path: str) -> Words:
    """One memory for all tasks of a worker."""
    return Words(path)


def slices(batch: pa.RecordBatch):
    """(doc_id, row, text) lists of a few MB."""
    docs, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    at, texts, size = 0, [], 0
    for k, text in enumerate(batch.column(2)):
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if size >= SLICE or k == len(docs) - 1:
            yield docs[at: k + 1], rows[at: k + 1], texts
            at, texts, size = k + 1, [], 0


def cut_pieces(path: str, capacity: int, end_id: int):
    end, step = np.array([end_id], dtype="<u4").tobytes(), 4 * capacity

    def batches(it):
        words = words_of(path)
        for batch in it:
            for docs, rows, texts in slices(batch):
                out = [[] for _ in range(6)]
                for doc, row, ids in zip(docs, rows, words.ids(texts)):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), step)):
                        part = ids[at: at + step]
                        for column, value in zip(out, (doc, row, k, at // 4, len(part) // 4, zlib.crc32(part))):
                            column.append(value)
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)],
                                                 ["doc_id", "row", "piece", "start", "length", "ids_crc32"])
    return batches


class Gaps:
    """Open sequences by the gap they have left: intervals of sequence numbers per gap."""

    def __init__(self):
        self.gaps: list[int] = []
        self.at: dict[int, list[tuple[int, int]]] = {}

    def add(self, gap: int, first: int, n: int) -> None:
        if gap <= 0 or n <= 0:
            return
        if gap not in self.at:
            bisect.insort(self.gaps, gap)
            self.at[gap] = []
        self.at[gap].append((first, n))

    def take(self, length: int, n: int) -> tuple[int, int, int] | None:
        """Up to ``n`` sequences of the smallest gap that holds ``length``: gap, first, number."""
        k = bisect.bisect_left(self.gaps, length)
        if k == len(self.gaps):
            return None
        gap = self.gaps[k]
        first, have = self.at[gap].pop()
        if have > n:
            self.at[gap].append((first + n, have - n))
        elif not self.at[gap]:
            del self.at[gap]
            self.gaps.pop(k)
        return gap, first, min(n, have)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Placements (length, first rank, number, first sequence, offset) of all pieces."""
    out, gaps, sequences = [], Gaps(), 0
    left = dict(histogram)
    used = dict.fromkeys(histogram, 0)

    def place(length: int, n: int, first: int, offset: int) -> None:
        out.append((length, used[length], n, first, offset))
        used[length] += n
        left[length] -= n

    large = sorted(k for k in left if 3 * k > capacity)
    for length in reversed(large):
        while left[length]:
            k = bisect.bisect_right(large, min(length, capacity - length)) - 1
            while k >= 0 and (not left[large[k]] or large[k] == length and left[length] < 2):
                k -= 1
            mate = large[k] if k >= 0 else 0
            n = left[length] // 2 if mate == length else min(left[length], left[mate]) if mate else left[length]
            place(length, n, sequences, 0)
            if mate:
                place(mate, n, sequences, length)
            gaps.add(capacity - length - mate, sequences, n)
            sequences += n
    for length in sorted((k for k in left if 3 * k <= capacity), reverse=True):
        while left[length]:
            found = gaps.take(length, left[length])
            if found:
                gap, first, n = found
                place(length, n, first, capacity - gap)
                gaps.add(gap - length, first, n)
                continue
            each = capacity // length
            n = left[length] // each or 1
            for k in range(each if left[length] >= each else left[length]):
                place(length, n, sequences, k * length)
                gap = capacity - (k + 1) * length
            gaps.add(gap, sequences, n)
            sequences += n
    return out


def pack_documents(docs: DataFrame, capacity: int = 2048, tokenizer: str | None = None, end_id: int = 0,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``,
    ``sequence_id`` and ``offset`` (gapless from 0 within the sequence).

    A document's ids are the tokenizer's (special tokens in the text included), then
    ``end_id``; null and empty texts are that id alone. Documents longer than ``capacity``
    are cut into full pieces and a rest; a very long text is encoded whole by one task.
    Repeated rows are packed one by one, ties of length go by identifier, row and piece;
    further columns are ignored; an empty table gives an empty
    result. ``tokenizer`` is the path of a vocabulary file present on every executor.
    """
    path = tokenizer or tokenizer_path()
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                        F.col(text_col).alias("text"))
    pieces = written(texts.mapInArrow(cut_pieces(path, capacity, end_id), PIECES), "pieces")
    # at most `capacity` rows, whatever the number of documents
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    spark = docs.sparkSession
    placements = spark.createDataFrame(plan(histogram, capacity), "length long, first long, n long, sequence long, at long")
    ranked = numbered(pieces, ["length"], ["doc_id", "row", "piece"], "rank")
    p = written(placements, "placements").alias("p")  # a few rows a length: Spark broadcasts them by their size
    here = (F.col("r.length") == F.col("p.length")) & (F.col("r.rank") >= F.col("p.first")) & (F.col("r.rank") < F.col("p.first") + F.col("p.n"))
    return (ranked.alias("r").join(p, here)
            .select(F.col("r.doc_id").alias(id_col), "r.piece", "r.start", "r.length", "r.ids_crc32",
                    (F.col("p.sequence") + F.col("r.rank") - F.col("p.first")).alias("sequence_id"), F.col("p.at").alias("offset")))

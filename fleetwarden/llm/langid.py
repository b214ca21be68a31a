"""Language identification by nearest centroids.

A text's vector holds the TF-IDF weights of its byte bigrams and trigrams (letters in lower
case, everything else in ASCII a blank), hashed to a fixed number of dimensions and
normalised. Each language has several centroids, found by spherical k-means; a text takes
the language of the centroid with the largest cosine. A text much further from it than
nearly all known text of that language and of its length gets rejected; how far that is, is
learned by centroids of one half of a language's sample from the passages of the other half.

The model is fitted on the driver from a bounded sample: at most ``per_language`` labelled
documents of a language, those with the smallest hash of their identifier. Only their count
vectors travel, never texts. Prediction reads every whole text, in Arrow batches.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh

DIMS = 1 << 13
#: Texts are counted together up to so many characters and so many texts.
SLICE_CHARS, SLICE_TEXTS = 2_000_000, 256
#: Lengths in words at which the distance of known text is learned.
LENGTHS = tuple(1 << k for k in range(11))
#: With fewer cosines of a length a language also takes the floor of all languages together.
FEW = 20
UNKNOWN = "und"

_KEEP = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def counts(texts: list[str]) -> np.ndarray:
    """Gram counts, a row for each text."""
    raw = [b" " + t.lower().encode("utf-8", "replace").translate(_KEEP) + b"  " for t in texts]
    a = np.frombuffer(b"".join(raw) + b"  ", dtype=np.uint8).astype(np.uint32)
    at = np.repeat(np.arange(len(raw), dtype=np.int64) * DIMS, [len(r) for r in raw])
    two = a[:-2] << np.uint32(8) | a[1:-1]
    blank = two == 0x2020  # also between two texts
    three = two << np.uint32(8) | a[2:]
    out = np.zeros(len(raw) * DIMS, dtype=np.int64)
    for gram in (two + np.uint32(1 << 24), three):
        slot = (gram * np.uint32(2654435761) >> np.uint32(32 - 13)).astype(np.int64)
        out += np.bincount((slot + at)[~blank], minlength=len(out))
    return out.reshape(len(raw), DIMS)


def weighted(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(tf).astype(np.float32) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    floor: np.ndarray  # smallest accepted cosine of each centroid at each of LENGTHS

    def predict(self, texts: list) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and rejection of each text."""
        lang, score, far = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
        todo = [k for k, t in enumerate(texts) if has_letter(t)] if self.languages else []
        at = 0
        while at < len(todo):
            to, size = at, 0
            while to < len(todo) and to - at < SLICE_TEXTS and (size < SLICE_CHARS or to == at):
                size += len(texts[todo[to]])
                to += 1
            part = todo[at:to]
            cos = weighted(counts([texts[k] for k in part]), self.idf) @ self.centroids.T
            best = cos.argmax(axis=1)
            words = np.array([len(texts[k].split()) for k in part])
            for k, b, c, w in zip(part, best, cos[np.arange(len(part)), best], words):
                lang[k], score[k] = self.languages[b], min(1.0, max(0.0, float(c)))
                far[k] = c < np.interp(np.log2(max(1, w)), np.arange(len(LENGTHS)), self.floor[b])
            at = to
        return lang, score, far


def clustered(v: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means from the first vector and those furthest from the ones chosen."""
    chosen = v[:1]
    while len(chosen) < min(k, len(v)):
        chosen = np.vstack([chosen, v[(v @ chosen.T).max(axis=1).argmin()]])
    for _ in range(rounds):
        own = (v @ chosen.T).argmax(axis=1)
        chosen = np.vstack([v[own == c].sum(axis=0) if (own == c).any() else chosen[c] for c in range(len(chosen))])
        chosen = chosen / np.maximum(np.linalg.norm(chosen, axis=1, keepdims=True), 1e-12)
    return chosen


def _count_sample(it):
    """Sparse counts of each text (words -1) and of passages from its middle, as arrays of
    places and counts in bytes: the driver then holds a few KB for each. Equal texts are in
    the same half."""
    for batch in it:
        out = [[], [], [], [], []]
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            if not has_letter(text):
                continue
            words, half = text.split(), zlib.crc32(text.encode("utf-8", "replace")) % 2
            mid = len(words) // 2
            parts = [(-1, text)] + [(n, " ".join(words[mid: mid + n])) for n in LENGTHS if mid + n <= len(words)]
            for n, part in parts:
                if has_letter(part):
                    row = counts([part])[0]
                    at = np.flatnonzero(row)
                    for column, value in zip(out, (lang, half, n, at.astype("<u2").tobytes(), row[at].astype("<f4").tobytes())):
                        column.append(value)
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], ["lang", "half", "words", "at", "n"])


def dense(rows: list) -> np.ndarray:
    out = np.zeros((len(rows), DIMS), dtype=np.float32)
    for k, r in enumerate(rows):
        out[k, np.frombuffer(r["at"], dtype="<u2")] = np.frombuffer(r["n"], dtype="<f4")
    return out


def held_out(id_col: str):
    """The third of the documents that no model learns from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_language: int = 150, clusters: int = 4, slack: float = 0.6, least: float = 0.05) -> Model:
    """``slack``: the accepted cosine, as a part of the one that all but the share ``least``
    of the sample's passages of that language and length have with centroids of the half of
    the sample that they are not in. Lengths without a passage take the nearest one with
    passages; a table whose languages have one text each has no floor."""
    label = (docs.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}") & ~F.coalesce(held_out(id_col), F.lit(False)))
             .select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
             .withColumn("key", F.xxhash64("id", "lang", "text")))
    first = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id", "key")
    # the limit per language is applied in each task before the shuffle; texts do not move
    rows_of = label.select("id", "lang", "key").withColumn("k", F.row_number().over(first)).where(F.col("k") <= per_language)
    chosen = [r["key"] for r in rows_of.select("key").collect()]
    # a row that is repeated very often counts once: equal rows meet in their task first
    sample = label.where(F.col("key").isin(chosen) if chosen else F.lit(False)).groupBy("key", "lang").agg(F.first("text").alias("text")).select("lang", "text")
    rows = sample.mapInArrow(_count_sample, "lang string, half int, words int, at binary, n binary").collect()
    return learned(rows, clusters, slack, least)


def learned(rows: list, clusters: int, slack: float, least: float) -> Model:
    rows = sorted(rows, key=lambda r: (r["lang"], r["words"], bytes(r["at"]), bytes(r["n"])))
    whole = [r for r in rows if r["words"] == -1]
    held = dense(whole)
    idf = (np.log((1 + len(whole)) / (1 + (held > 0).sum(axis=0))) + 1).astype(np.float32)
    held = weighted(held, idf)
    lang, half = np.array([r["lang"] for r in whole], dtype=object), np.array([r["half"] for r in whole])
    of, centroids, cosines = [], [], {}
    for name in sorted(set(lang)):
        c = clustered(held[lang == name], clusters)
        of += [name] * len(c)
        centroids.append(c)
        cosines[name] = {}
        for h in (0, 1):
            others = held[(lang == name) & (half != h)]
            mine = [r for r in rows if r["lang"] == name and r["half"] == h and r["words"] != -1]
            if not len(others):
                continue
            c = clustered(others, clusters)
            for at in range(0, len(mine), 256):  # passages are dense a few at a time
                part = mine[at: at + 256]
                for r, cos in zip(part, (weighted(dense(part), idf) @ c.T).max(axis=1)):
                    cosines[name].setdefault(r["words"], []).append(float(cos))
    floor = slack * floors(cosines, least)
    return Model(of, np.vstack(centroids) if of else np.zeros((0, DIMS)), idf, np.array([floor[sorted(cosines).index(name)] for name in of]))


def floors(cosines: dict[str, dict[int, list[float]]], least: float) -> np.ndarray:
    """The cosine at each of LENGTHS that the share ``least`` of the cosines of a language
    lies below, a row for each language in order. It never falls with the length."""
    together = {n: [c for found in cosines.values() for c in found.get(n, ())] for n in LENGTHS}
    out = np.zeros((len(cosines), len(LENGTHS)))
    for row, name in zip(out, sorted(cosines)):
        low = {n: min(np.quantile(x, least) for x in ([mine, together[n]] if len(mine) < FEW else [mine]) if x)
               for n in LENGTHS for mine in [cosines[name].get(n, [])] if together[n]}
        if low:
            row[:] = [low[min(low, key=lambda m: abs(np.log2(m / n)))] for n in LENGTHS]
    return np.minimum.accumulate(out[:, ::-1], axis=1)[:, ::-1]


def predict(docs: DataFrame, model: Model, text_col: str = "text", out: str = "language") -> DataFrame:
    """Adds the struct ``out`` (``lang_pred``, ``score``, ``rejected``) to every row."""
    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def language(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            lang, score, far = model.predict([t if isinstance(t, str) else None for t in texts])
            yield pd.DataFrame({"lang_pred": lang, "score": score, "rejected": far})
    return docs.withColumn(out, language(F.col(text_col)))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **fitting) -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``lang_pred``, ``score`` (cosine of
    the nearest centroid, 0 to 1) and ``rejected``.

    Null texts and texts without a letter are ``und`` with score 0 and rejected; so is every
    text when no labelled document is left to learn from. Rows with a null label or null
    identifier are predicted like others (a null identifier is not held out). Repeated rows
    get equal results; further columns are ignored; an empty table gives an empty result.
    """
    model = fit(docs, id_col, text_col, lang_col, **fitting)
    kept = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return (predict(kept, model).select(F.col("doc_id").alias(id_col), F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"),
                                        "language.lang_pred", "language.score", "language.rejected"))


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **fitting) -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns kept."""
    (out,) = fresh(docs, "_language")
    found = predict(docs, fit(docs, id_col, text_col, lang_col, **fitting), text_col, out)
    return found.where(~F.col(f"{out}.rejected")).drop(out)

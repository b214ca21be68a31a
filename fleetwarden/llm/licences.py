"""Licence scan with a positional index of rare words.

The index is made of licence templates: for each word its postings (template, place). How
rare a word is, the documents say: one pass counts in how many of them each licence word
stands. A file is then scanned in three steps.

1. Its licence words are looked up, the ones with the highest IDF first. A template goes on
   if the file has all words of one of its key phrases; its ``LOOKUPS`` rarest words that the
   file has are the ones looked up.
2. A word at place f of the file and place p of the template says that the template would
   start at f - p. Starts that several looked-up words agree on, within ``SLACK`` words, are
   alignments.
3. An alignment holds if one of the template's key phrases stands in its window as a whole
   and the words found near their places make up enough of the template's IDF.

The plain phrases are templates too: all of their words must stand consecutively, and every
place of them counts.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM

#: Rarest words of a template that are looked up in a file.
LOOKUPS = 4
#: Words by which edits may shift a place against its template.
SLACK = 3

#: Phrases that count wherever they stand, and their labels (fixed values).
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: Licence notices: label, text, key phrases of which one must stand in the file (fixed values).
NOTICES = [
    ("agpl-3.0", "GNU Affero General Public License version 3", ["affero general public license"]),
    ("apache-2.0", "Apache License, Version 2.0", ["apache license version 2 0", "apache license 2 0", "apache 2 0 license"]),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met", ["redistribution and use in source and binary forms"]),
    ("bsl-1.0", "Boost Software License, Version 1.0", ["boost software license"]),
    ("cc-by-4.0", "CC BY 4.0", ["cc by 4 0"]),
    ("cc-by-4.0", "Creative Commons Attribution 4.0 International License",
     ["creative commons attribution 4 0 international"]),
    ("cc-by-nc-4.0", "CC BY-NC 4.0", ["cc by nc 4 0"]),
    ("cc-by-sa-4.0", "CC BY-SA 4.0", ["cc by sa 4 0"]),
    ("cc0-1.0", "CC0 1.0 Universal", ["cc0 1 0"]),
    ("epl-2.0", "Eclipse Public License 2.0", ["eclipse public license"]),
    ("gpl-2.0", "GNU General Public License, version 2",
     ["gnu general public license version 2", "gnu general public license v2"]),
    ("gpl-3.0", "GNU General Public License, version 3",
     ["gnu general public license version 3", "gnu general public license v3"]),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
     ["permission to use copy modify and or distribute this software"]),
    ("lgpl", "GNU Lesser General Public License", ["lesser general public license"]),
    ("mit", "MIT License", ["mit license", "mit licensed"]),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the software without restriction, including without limitation the rights to use, "
            "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software",
     ["permission is hereby granted free of charge", "use copy modify merge publish distribute sublicense"]),
    ("mpl-2.0", "Mozilla Public License, v. 2.0", ["mozilla public license"]),
    ("unlicense", "This is free and unencumbered software released into the public domain",
     ["free and unencumbered software released into the public domain"]),
]


def words_of(text: bytes | str | None) -> list[bytes]:
    """Runs of digits, letters and bytes beyond ASCII, A-Z lower-cased."""
    raw = text.encode() if isinstance(text, str) else text or b""
    return raw.translate(ALNUM).split()


@dataclass
class Template:
    label: str
    words: list[bytes]
    keys: list[list[bytes]]


def templates(notices: Iterable[tuple[str, str, list[str]]]) -> list[Template]:
    return [Template(label, words_of(text), [words_of(k) for k in keys]) for label, text, keys in notices]


def consecutive(words: list[bytes], phrase: list[bytes], places: dict[bytes, list[int]], rarest: bytes,
                lo: int = 0, hi: int | None = None) -> list[int]:
    """Starts from ``lo`` to before ``hi`` at which ``phrase`` stands, by the places of its rarest word."""
    off, at = phrase.index(rarest), places.get(rarest, [])
    of = at[bisect_left(at, lo + off): len(at) if hi is None else bisect_left(at, hi + off)]
    return [f - off for f in of if words[f - off: f - off + len(phrase)] == phrase]


class Index:
    """The templates, with postings by word, under the given IDF of words."""

    def __init__(self, phrases: dict[str, str], notices: list[tuple[str, str, list[str]]], idf: dict[bytes, float], least: float) -> None:
        self.phrases = [(words_of(p), label) for p, label in sorted(phrases.items())]
        self.templates, self.idf, self.least = templates(notices), idf, least
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        for t, template in enumerate(self.templates):
            for p, w in enumerate(template.words):
                self.postings.setdefault(w, []).append((t, p))
        self.words = vocabulary(phrases, notices)

    def rarest(self, words: Iterable[bytes]) -> list[bytes]:
        return sorted(set(words), key=lambda w: (-self.idf.get(w, 0.0), w))

    def base(self, words: list[bytes], hits: set[bytes], places: dict[bytes, list[int]]) -> list[tuple[str, int]]:
        return [(label, at) for phrase, label in self.phrases if hits.issuperset(phrase)
                for at in consecutive(words, phrase, places, self.rarest(phrase)[0])]

    def alignments(self, hits: set[bytes], places: dict[bytes, list[int]], open_: set[int]):
        """(template, first start, last start) that enough looked-up words agree on."""
        left = {t: LOOKUPS for t in open_}
        starts: dict[int, list[tuple[int, int]]] = {t: [] for t in open_}
        for k, w in enumerate(self.rarest(hits)):
            of = [(t, p) for t, p in self.postings.get(w, ()) if left.get(t)]
            for t, p in of:
                starts[t] += [(f - p, k) for f in places[w]]
            for t in {t for t, _ in of}:
                left[t] -= 1
        for t in sorted(starts):
            needed = min(2, LOOKUPS - left[t])
            votes, to, seen = sorted(starts[t]), 0, None
            for k, (first, _) in enumerate(votes):
                while to < len(votes) and votes[to][0] <= first + SLACK:
                    to += 1
                span = (first, votes[to - 1][0])
                if span != seen and len({w for _, w in votes[k: to]}) >= needed > 0:
                    seen = span
                    yield t, *span

    def found(self, words: list[bytes], hits: set[bytes], places: dict[bytes, list[int]]) -> list[tuple[str, int, float]]:
        """(label, place of the key phrase, share of the template's IDF) of the verified alignments."""
        open_ = {t for t, template in enumerate(self.templates) if any(hits.issuperset(k) for k in template.keys)}
        out: dict[tuple[str, int], float] = {}
        for t, first, last in self.alignments(hits, places, open_) if open_ else ():
            template = self.templates[t]
            lo, hi = max(0, first - SLACK), last + len(template.words) + SLACK
            keys = [at for key in template.keys if hits.issuperset(key)
                    for at in consecutive(words, key, places, self.rarest(key)[0], lo, hi)]
            if keys:
                weights = [self.idf.get(w, 0.0) for w in template.words]
                near = [weight for p, (w, weight) in enumerate(zip(template.words, weights))
                        if w in words[max(0, first + p - SLACK): max(0, last + p + SLACK + 1)]]
                share = sum(near) / sum(weights)
                if share >= self.least:
                    at = (template.label, min(keys))
                    out[at] = max(share, out.get(at, 0.0))
        return sorted((*at, share) for at, share in out.items())

    def scan(self, words: list[bytes]) -> tuple[list[tuple[str, int]], list[tuple[str, int, float]]]:
        hits = self.words.intersection(words)
        some = [p for p, _ in self.phrases] + [k for t in self.templates for k in t.keys]
        if not any(hits.issuperset(p) for p in some):
            return [], []
        places: dict[bytes, list[int]] = {w: [] for w in hits}
        for at, w in enumerate(words):
            if w in hits:
                places[w].append(at)
        return self.base(words, hits, places), self.found(words, hits, places)


def vocabulary(phrases: dict[str, str], notices: list[tuple[str, str, list[str]]]) -> frozenset[bytes]:
    texts = [*phrases, *(text for _, text, _ in notices), *(k for _, _, keys in notices for k in keys)]
    return frozenset(w for t in texts for w in words_of(t))


def licence_idf(texts: DataFrame, vocab: frozenset[bytes]) -> dict[bytes, float]:
    """ln(1 + N / (1 + n)) of each licence word: N documents, n of them with the word. No
    more rows than licence words reach the driver."""
    def batches(it):
        seen: Counter[bytes] = Counter()
        for batch in it:
            seen[b""] += batch.num_rows
            for k in range(batch.num_rows):
                seen.update(vocab.intersection(words_of(batch.column(0)[k].as_py())))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
    rows = texts.mapInArrow(batches, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    n = {bytes(r.word): r.n for r in rows}
    return {w: math.log(1 + n.get(b"", 0) / (1 + n.get(w, 0))) for w in vocab}


def scanned(index: Index):
    places, found = pa.struct([("label", pa.string()), ("word", pa.int64())]), pa.struct(
        [("label", pa.string()), ("word", pa.int64()), ("share", pa.float64())])

    def batches(it):
        for batch in it:
            n_words, base, more = [], [], []
            for k in range(batch.num_rows):
                words = words_of(batch.column(1)[k].as_py())
                of_phrases, of_notices = index.scan(words)
                n_words.append(len(words))
                base.append([{"label": label, "word": at} for label, at in of_phrases])
                more.append([{"label": label, "word": at, "share": share} for label, at, share in of_notices])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(base, pa.list_(places)),
                                              pa.array(more, pa.list_(found))], ["doc_id", "n_words", "phrases", "notices"])
    return batches


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] | None = None,
                  notices: list[tuple[str, str, list[str]]] | None = None, least: float = 0.6) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``phrases`` (label and first
    word of every place of a plain phrase) and ``notices`` (label, first word of the key
    phrase and share of the template's IDF, ``least`` at least, of every notice found).

    Null, empty and blank texts have no words and no finds. Repeated rows and identifiers
    are rows of their own, a null identifier stays null. Texts are scanned whole, and every
    place is reported, however many there are. Documents that hold no licence word are
    read once to count words and once to be scanned, and nothing is shuffled but the counts.
    Further columns are ignored; an empty table gives an empty result.
    """
    phrases, notices = PHRASES if phrases is None else phrases, NOTICES if notices is None else notices
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    idf = licence_idf(rows.select("text"), vocabulary(phrases, notices))
    schema = ("doc_id long, n_words long, phrases array<struct<label: string, word: long>>, "
              "notices array<struct<label: string, word: long, share: double>>")
    return rows.mapInArrow(scanned(Index(phrases, notices, idf, least)), schema)

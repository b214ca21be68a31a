"""Importance resampling, periodic runs and licence scans against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from fleetwarden.llm import resampling as R
from fleetwarden.llm.licences import NOTICES, PHRASES, scan_licences
from fleetwarden.llm.periodic import periodic_runs, runs
from fleetwarden.llm.queries import QUERIES, repeating
from fleetwarden.llm.resampling import importance_resample
from tests.conftest import SF_SMALL

LOWER = {k: k + 32 for k in range(65, 91)}


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def buckets_of(text):
    w = alnum(text)
    return [zlib.crc32(f.encode()) % 10_000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def slow_resample(docs, targets):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(buckets_of(text))
    for text in targets:
        t.update(buckets_of(text))
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10_000) / ((s[b] + 1) * (t.total() + 10_000)))) for b in range(10_000)}
    rows = []
    for i, text in docs:
        found = buckets_of(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((r for r in rows if r[1] >= 39), key=lambda r: (-r[3], r[0] is None, r[0]))
    rank = {id(r): k + 1 for k, r in enumerate(order[: 25 * len(order) // 100])}
    return [(*r, rank.get(id(r))) for r in rows]


def key(row):
    return tuple((x is None, x) for x in row)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=key)


def test_resampling_query_against_brute_force(spark, docs):
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    want = slow_resample([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in bench.collect()])
    assert rows_of(QUERIES["op11_importance_resampling"](spark, SF_SMALL)) == sorted(want, key=key)


def test_resampling_odd_rows(odd, none, monkeypatch):
    monkeypatch.setattr(R, "BLOCK", 1000)
    got, rows = importance_resample(odd, odd), [(r.doc_id, r.text) for r in odd.collect()]
    assert rows_of(got) == sorted(slow_resample(rows, [t for _, t in rows]), key=key)
    assert importance_resample(none, odd).count() == 0
    assert rows_of(importance_resample(odd, none)) == sorted(slow_resample(rows, []), key=key)


def test_long_texts_are_scanned_in_pieces(monkeypatch):
    rng = random.Random(1)
    monkeypatch.setattr(R, "GROUP", 50)
    monkeypatch.setattr(R, "DICTIONARY", 30)
    monkeypatch.setattr(R, "BLOCK", 17)
    texts = [" ".join(rng.choice(["Ab", "c", "é1", "dd-", "x" * 70, f"w{rng.randrange(60)}"]) for _ in range(n)) for n in (0, 1, 2, 300, 5, 0, 700)]
    words = R.Words()
    for most in (1, 2, 3):
        payload, counts = R.payloads(words, [R.plain(t.encode()) for t in texts])
        values, n = R.composed(payload, counts, most, 10_000)
        ends = np.cumsum(n)
        for t, e, c in zip(texts, ends, n):
            w = alnum(t)
            want = [zlib.crc32(" ".join(w[k: k + m]).encode()) % 10_000 for m in range(1, most + 1) for k in range(len(w) - m + 1)]
            assert sorted(values[e - c: e].tolist()) == sorted(want)


def test_ranks_are_gapless_over_ranges(spark):
    rows = [(k % 700, "one two three four five six seven eight nine ten " * 2 + f"w{k % 5}") for k in range(2000)]
    df = spark.createDataFrame(rows + [(7, rows[7][1])] * 500, "doc_id long, text string").repartition(7)
    got = importance_resample(df, df.limit(3)).collect()
    drawn = sorted((r.rank, -r.score, r.doc_id) for r in got if r.rank)
    assert [r for r, *_ in drawn] == list(range(1, 626)) and [x[1:] for x in drawn] == sorted(x[1:] for x in drawn)
    left = [(-r.score, r.doc_id) for r in got if not r.rank]
    assert min(left) >= drawn[-1][1:]


def slow_runs(w, least=12):
    """Every maximal stretch of a lag, with its smallest period."""
    out = set()
    for q in range(1, len(w) // 2 + 1):
        k = q
        while k < len(w):
            e = k
            while e < len(w) and w[e] == w[e - q]:
                e += 1
            s = k - q
            if e > k and e - s >= max(least, 2 * q) and not any(all(w[x] == w[x - p] for x in range(s + p, e)) for p in range(1, q)):
                out.add((s, e - s, q))
            k = e + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, found):
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


@pytest.mark.parametrize("seed", range(60))
def test_runs_against_every_lag(seed):
    rng = random.Random(seed)
    letters = "ab" if seed % 3 else "abcdefgh"
    w = []
    while len(w) < 60 + 9 * seed:
        part = [rng.choice(letters) for _ in range(rng.randrange(1, 5 + seed))]
        w += part * rng.randrange(1, 5) + part[: rng.randrange(len(part))]
    if seed % 5 == 0:
        w = ["a"] * len(w)
    start, end, period = runs(np.unique(w, return_inverse=True)[1])
    assert [(s, e - s, q) for s, e, q in zip(start.tolist(), end.tolist(), period.tolist())] == slow_runs(w)


def woven(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if doc_id is None or h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[a + (k - a) % p] if k >= a else w[k] for k in range(n)]


def slow_periodic(doc_id, text):
    w = woven(doc_id, text)
    found = slow_runs(w)
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(w, found).encode()).hexdigest())


def test_periodic_query_against_brute_force(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = {i: slow_periodic(i, t) for i, t in rows if len((t or "").split()) < 1500}
    got = {r.doc_id: tuple(r) for r in QUERIES["op12_periodic_runs"](spark, SF_SMALL).collect()}
    assert len(got) == len(rows) and {i: got[i] for i in want} == want and sum(r[1] > 0 for r in want.values()) > 10
    assert {r.doc_id: r.text.split() for r in repeating(docs).collect() if r.text} == {i: woven(i, t) for i, t in rows if t}


def test_periodic_odd_rows(spark, odd, none):
    got = {r.doc_id: r for r in periodic_runs(odd).collect()}
    assert len(got) == len({r.doc_id for r in odd.collect()}) and periodic_runs(none).count() == 0
    assert got[0].n_words == 0 and got[0].runs == [] and got[0].collapsed == "" == got[2].collapsed
    assert [tuple(r) for r in got[10].runs] == [(0, 30_000, 1009)] and len(got[10].collapsed.split()) == 1009
    texts = ["same " * 50_000, "a b " * 20_000 + "c " + "a b " * 20_000, "x " * 11, "x " * 12, "  é " * 7]
    r = periodic_runs(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [[tuple(x) for x in y.runs] for y in r] == [[(0, 50_000, 1)], [(0, 40_000, 2), (40_001, 40_000, 2)], [], [(0, 12, 1)], [(0, 14, 2)]]
    assert [y.collapsed for y in r[:2]] == ["same", "a b c a b"] and r[4].collapsed == "  é"


def slow_base(text):
    w = alnum(text)
    return len(w), sorted((label, k) for p, label in PHRASES.items() for k in range(len(w)) if w[k: k + len(p.split())] == p.split())


def test_licence_query_against_brute_force(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op13_licence_scan"](spark, SF_SMALL).collect()}
    for r in docs.collect():
        n, places = slow_base(r.text)
        g, at = got[r.doc_id], [k for _, k in places]
        assert (g.n_words, g.n_base, g.first_word, g.last_word) == (n, len(places), min(at, default=None), max(at, default=None))
        labels = {label for label, _ in places}
        assert g.base_labels == ",".join(sorted(labels)) and set(filter(None, g.labels.split(","))) >= labels and 0 <= g.score <= 1
        more = {"MIT License": "mit", "Apache License, Version 2.0": "apache-2.0", "License, version 3": "gpl-3.0", "CC BY-NC 4.0": "cc-by-nc-4.0"}
        labels |= {label for phrase, label in more.items() if phrase in (r.text or "")}
        assert g.labels == ",".join(sorted(labels)) and (g.score > 0) == bool(labels)


def test_notices_in_other_text(spark):
    rng = random.Random(3)
    prose = lambda n: " ".join(rng.choice(["of", "the", "is", "to", "alpha", "this", "use", "license", "public"]) for _ in range(n))
    rows = [(k, f"{prose(50)}\n# {text.upper()}.\n{prose(30)}") for k, (_, text, _) in enumerate(NOTICES)]
    rows += [(100, prose(5000)), (101, "permission is hereby granted free of charge"), (102, "the mit license, the mit license; " * 3)]
    edited = NOTICES[-3][1].replace("obtaining a copy", "who obtains copies").replace("to deal", "thus to deal")
    rows += [(103, f"{prose(20)} {edited} {prose(9)}"), (104, "rights reserved all cc, by general license public")]
    got = {r.doc_id: r for r in scan_licences(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    for k, (label, _, _) in enumerate(NOTICES):
        assert label in {n.label for n in got[k].notices}, label
    assert not got[100].notices and not got[101].notices and [n.label for n in got[103].notices] == ["mit"]
    assert {n.label for n in got[102].notices} == {"mit"} and {(p.label, p.word) for p in got[104].phrases} == {("cc-by", 3)}


def test_licence_odd_rows(odd, none):
    got = scan_licences(odd).collect()
    assert len(got) == odd.count() and not any(r.notices or r.phrases for r in got)
    assert {r.n_words for r in got if r.doc_id in (0, 1, 2)} == {0} and scan_licences(none).count() == 0

"""Suffix-array dedup and collinear chaining against brute force."""

import hashlib
import random
from collections import Counter

from fleetwarden.llm import substrings as S
from fleetwarden.llm.chaining import common_words, repeated_passages
from fleetwarden.llm.substrings import common, decoded, dedup_substrings, front_coded, merged


def brute(rows, n):
    raws = [(t or "").encode() for t in rows]
    seen = Counter(b[k: k + n] for b in raws for k in range(len(b) - n + 1))
    out = []
    for b in raws:
        gone = bytearray(len(b))
        for k in range(len(b) - n + 1):
            if seen[b[k: k + n]] > 1:
                gone[k: k + n] = b"\1" * n
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return out


def check(spark, texts, n=400, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in dedup_substrings(df, n, **kw).collect()}
    assert [got[k] for k in range(len(texts))] == brute(texts, n)


def test_planted_passages(spark):
    rng = random.Random(1)
    prose = lambda n: "".join(rng.choice("abcde é") for _ in range(n))
    passages = [prose(n) for n in (300, 380, 398, 400, 401, 430, 700, 2000)]
    texts = []
    for _ in range(40):
        parts = [prose(rng.randrange(200)) for _ in range(3)] + rng.sample(passages, 2)
        rng.shuffle(parts)
        cut = rng.randrange(60)
        texts.append("".join(parts)[cut:])
    near = prose(3000)
    texts += [near[:k] + "#" + near[k + 1:] for k in (5, 399, 400, 401, 1500, 2600, 2999)]
    check(spark, texts + [None, "", "ab" * 900, "ab" * 500, "z" * 399, "z" * 400, "y" * 401, "é" * 400], range_records=50)


def test_segments_of_long_texts(spark, monkeypatch):
    rng = random.Random(2)
    a = "".join(rng.choice("abcdef") for _ in range(9000))
    raws = [(k, t) for k, t in enumerate([a, a[100:5000] + "x" + a[5000:], "q" + a[7000:]])]
    monkeypatch.setattr(S, "SEGMENT", 1000)
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array([k for k, _ in raws]), pa.array([t.encode() for _, t in raws])], ["doc", "text"])
    starts = Counter((k, at + p) for g in S.segments(batch, 400) for k, at, part in g for p in range(len(part) - 399))
    assert set(starts.values()) == {1} and len(starts) == sum(len(t) - 399 for _, t in raws)


def test_merged_order_decides(monkeypatch):
    """Windows by the merge alone, against all pairs of records; without the common
    prefixes that the merge found, nothing repeats."""
    rng = random.Random(12)
    monkeypatch.setattr(S, "SPAN", 6)
    part = lambda n: bytes(rng.choice(b"ab") for _ in range(n))
    for _ in range(40):
        shared = [part(20) for _ in range(3)]
        records = sorted((b"hash0000" + rng.choice(shared)[: rng.randrange(5, 20)] + part(rng.randrange(4)),
                          rng.choice(shared)[: rng.randrange(6)] + part(rng.randrange(3)), 1, k, k, 0) for k in range(25))
        runs = [decoded(front_coded(records[k::3])) for k in range(3)]
        got = merged(runs)
        spans = S.agreeing(got, 12)
        for i, (a, found) in enumerate(zip(got, spans)):
            want = {d for d in range(len(a[2]) + 1) for j, b in enumerate(got)
                    if i != j and common(a[2], b[2], 0) >= d and common(a[1], b[1], 0) - 8 >= max(12 - d, 12 - 6 + 1)}
            have = {d for lo, hi in found for d in range(lo, hi + 1)}
            may = {d for d in range(len(a[2]) + 1) for j, b in enumerate(got)
                   if i != j and common(a[2], b[2], 0) >= d and common(a[1], b[1], 0) - 8 >= 12 - d}
            assert want <= have <= may
        assert not any(S.agreeing([(0, *r[1:]) for r in got], 12))


def hot_texts(rng, n):
    """Boilerplate of 300, 394 and 450 bytes in ever different surroundings, some repeated."""
    prose = lambda k: "".join(rng.choice("abcdefgh ") for _ in range(k))
    plates = [prose(300), prose(394), prose(450)]
    texts = [prose(150 + rng.randrange(60)) + plates[k % 3] + prose(150 + rng.randrange(60)) for k in range(n)]
    return texts + [texts[3][40:], "x" + texts[4], plates[0] + texts[0][-100:]]


def test_hot_anchors_against_brute_force(spark):
    texts = hot_texts(random.Random(10), 150)
    for hot in (1, 5, 40, 10_000):
        check(spark, texts, hot_records=hot)


def test_hot_anchors_are_split(spark):
    """Records of one hash stay under the bound unless their windows do repeat; equal ones
    are one record in each task."""
    texts = [t for k, t in enumerate(hot_texts(random.Random(11), 600)[:600]) if k % 3 < 2]
    df = spark.createDataFrame([(k, k, t.encode()) for k, t in enumerate(texts)], "doc long, row long, text binary").repartition(4)
    most = lambda keys: max((r.n for r in keys.selectExpr("explode(hs) AS h").groupBy("h").agg(S.F.count("*").alias("n")).collect()), default=0)
    assert most(S.wanted_keys(df, 400, 10_000)) >= 200
    assert most(S.wanted_keys(df, 400, 20)) <= 20


def test_merge_of_front_coded_runs():
    rng = random.Random(3)
    records = [(bytes(rng.choice(b"ab") for _ in range(rng.randrange(8, 40))), bytes(rng.choice(b"xy") for _ in range(rng.randrange(5))), 1, k, k, k) for k in range(400)]
    for n in (1, 2, 5, 8):
        runs = [decoded(front_coded(sorted(records[k::n]))) for k in range(n)]
        got = merged(runs)
        assert [r[1] for r in got] == sorted(r[0] for r in records) and sorted(r[4] for r in got) == list(range(400))
        assert all(r[0] == common(r[1], p[1], 0) for p, r in zip(got, got[1:]))


def test_suffix_dedup_odd_rows(odd, none):
    rows = odd.collect()
    want = sorted(zip([r.doc_id or -1 for r in rows], brute([r.text for r in rows], 400)))
    got = sorted((r.doc_id or -1, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in dedup_substrings(odd).collect())
    assert got == want
    assert dedup_substrings(none).count() == 0


def test_longest_common_subsequence():
    rng = random.Random(4)
    for _ in range(50):
        a, b = [[rng.choice(b"abc") for _ in range(rng.randrange(12))] for _ in range(2)]
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert common_words(a, b) == t[-1][-1]


def test_fuzzy_passages(spark):
    rng = random.Random(5)
    words = lambda n: [f"{rng.randrange(10 ** 6):x}" for _ in range(n)]
    passage, short = words(120), words(30)
    edited = list(passage)
    for k in range(9, 120, 14):
        edited[k] = "edit"
    del edited[40], edited[80]
    texts = [words(100) + passage + words(40), words(7) + edited + words(60), words(50) + short, short + words(80),
             [w.upper() for w in passage], words(300)]
    df = spark.createDataFrame([(k + 10, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in repeated_passages(df).collect()}
    assert got[10].n_removed == 0 and got[12].n_removed == got[13].n_removed == got[15].n_removed == 0
    assert [list(map(int, s)) for s in got[14].spans] == [[0, 120]] and got[14].first_docs == [10]
    (a, b), = got[11].spans
    assert abs(a - 7) <= 6 and abs(b - 125) <= 6 and got[11].n_links == 1 and got[11].n_words == 185


def test_chaining_odd_rows(odd, none):
    got = repeated_passages(odd).collect()
    assert len(got) == odd.count() and repeated_passages(none).count() == 0
    by = {r.doc_id: r for r in got}
    assert by[0].n_words == 0 and by[13].n_removed >= 1990 and by[13].first_docs == [10] and by[3].n_links == 0


def test_passages_of_chains_that_fail_as_a_whole(spark):
    rng = random.Random(6)
    words = lambda n: [f"{rng.randrange(10 ** 6):x}" for _ in range(n)]
    a, b, c, d, stray = words(50), words(50), words(50), words(120), words(5)
    texts = [words(80) + a + b + words(80), words(80) + a + words(40) + b + words(80),
             words(80) + c + words(20) + stray + words(80), words(80) + c + words(20) + stray + words(80),
             words(80) + stray + words(45) + d + words(80), words(80) + stray + words(45) + d + words(80)]
    df = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: [tuple(map(int, s)) for s in r.spans or ()] for r in repeated_passages(df).collect()}
    assert got == {0: [], 1: [(80, 130), (170, 220)], 2: [], 3: [(80, 130)], 4: [], 5: [(130, 250)]}


def test_passage_of_phrases_that_stand_singly_in_earlier_documents(spark):
    rng = random.Random(7)
    words = lambda n: [f"{rng.randrange(10 ** 6):x}" for _ in range(n)]
    shared = [words(80) for _ in range(6)]
    texts = []
    for p in shared:  # each 5-word phrase of a passage is in one of the first documents
        texts += [words(100) + p[at: at + 13] + words(100) for at in range(0, 72, 8)]
    first = len(texts)
    texts += [words(90) + p + words(90) for p in shared] + [words(120) + p + words(70) for p in shared]
    df = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in repeated_passages(df).collect()}
    assert all(got[k].n_removed == 0 for k in range(first + 6))
    for k in range(6):
        r = got[first + 6 + k]
        assert [tuple(map(int, s)) for s in r.spans or ()] == [(120, 200)] and r.first_docs == [first + k]


def edited(rng, words, every, cut):
    """``words`` with one of every ``every`` replaced, or left out where ``cut``."""
    out, at = [], rng.randrange(every)
    for k, w in enumerate(words):
        if k % every != at:
            out.append(w)
        elif not (cut and rng.random() < 0.3):
            out.append(f"edit{rng.randrange(10 ** 6)}")
    return out


def test_recall_of_edited_passages(spark):
    """Every planted passage has 50 words or more on both sides and is 0.82 to 0.92 similar by
    its longest common subsequence; nine in ten are found, in each class of edits as well."""
    rng = random.Random(8)
    words = lambda n: [f"{rng.randrange(10 ** 6):x}" for _ in range(n)]
    texts, planted = [], {}
    for every in (6, 7, 8, 9, 10, 12):
        for n in (50, 55, 60, 80, 100):
            for _ in range(8):
                passage = words(n)
                copy = edited(rng, passage, every, n > 55)
                assert len(copy) >= 50 and common_words(passage, copy) >= 0.8 * max(len(passage), len(copy))
                texts.append(words(80) + passage + words(60))
                planted[len(texts)] = (every, n, 70, 70 + len(copy))
                texts.append(words(70) + copy + words(90))
    df = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    got = {r.doc_id: [tuple(map(int, s)) for s in r.spans or ()] for r in repeated_passages(df).collect()}
    assert not any(got[k] for k in got if k not in planted)
    caught = {k: any(a < end and start < b and min(b, end) - max(a, start) >= 0.8 * (end - start) for a, b in got[k])
              for k, (_, _, start, end) in planted.items()}
    for every in (6, 7, 8, 9, 10, 12):
        of = [caught[k] for k, p in planted.items() if p[0] == every]
        print(every, sum(of), len(of), {n: sum(caught[k] for k, p in planted.items() if p[:2] == (every, n)) for n in (50, 55, 60, 80, 100)})
    assert sum(caught.values()) >= 0.9 * len(caught)
    assert all(sum(caught[k] for k, p in planted.items() if p[0] == e) >= 0.8 * 40 for e in (7, 8, 9, 10, 12))
    wide = [caught[k] for k, p in planted.items() if p[1] >= 80]
    assert sum(wide) >= 0.95 * len(wide)


def test_passages_that_repeat_a_phrase(spark):
    rng = random.Random(9)
    words = lambda n: [f"{rng.randrange(10 ** 6):x}" for _ in range(n)]
    texts, planted = [], {}
    for phrase in (1, 2, 3, 5, 7, 11, 20):
        passage = words(phrase) * (100 // phrase)
        other = list(passage)
        other[len(other) // 2] = "edit"
        texts += [words(40) + passage + words(30), words(25) + passage + words(50), words(10) + other + words(40)]
        planted[len(texts) - 2] = (25, len(passage))
        planted[len(texts) - 1] = (10, len(other))
    whole = " ".join(words(4) * 5000)
    texts += [whole.split(), whole.split()]
    planted[len(texts) - 1] = (0, 20_000)
    df = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    got = {r.doc_id: [tuple(map(int, s)) for s in r.spans or ()] for r in repeated_passages(df).collect()}
    for k, (start, n) in planted.items():
        assert sum(min(b, start + n) - max(a, start) for a, b in got[k] if a < start + n and start < b) >= 0.9 * n, (k, got[k])
    assert not any(got[k] for k in got if k not in planted)


def test_seeds_are_deleted_once_the_first_documents_are_known(spark):
    import os

    from fleetwarden.llm.chaining import repeated_passages
    from fleetwarden.session import scratch_folders
    begun = set(scratch_folders(spark))
    text = " ".join(f"w{i}" for i in range(80))
    got = repeated_passages(spark.createDataFrame([(1, text), (2, text), (3, None)], "doc_id long, text string"))
    own = {os.path.basename(p).rsplit("-", 1)[0]: p.removeprefix("file:") for p in scratch_folders(spark) if p not in begun}
    assert not os.path.exists(own["seeds"]) and os.path.exists(own["sizes"])
    assert {r.doc_id: (r.n_words, r.n_removed) for r in got.collect()} == {1: (80, 0), 2: (80, 80), 3: (0, 0)}

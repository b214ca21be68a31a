"""Near-dedup, components, nearest neighbours and language identification."""

import re
import zlib

import numpy as np
import pytest
import xxhash

from fleetwarden.llm.ann import nearest_neighbours
from fleetwarden.llm.components import components
from fleetwarden.llm.langid import floors, identify, keep_identified
from fleetwarden.llm.simhash import close_links, drop_near_copies, fingerprint, simhash_groups


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({k: k + 32 for k in range(65, 91)}))
    if not words:
        return 0
    shingles = [" ".join(words[k: k + 3]) for k in range(max(1, len(words) - 2))]
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64(s.encode(), seed=42).intdigest()
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


def grouped(ids, fps, most=2):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(ids)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= most:
                x, y = root(ids[a]), root(ids[b])
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in ids]


def test_simhash_against_all_pairs(docs):
    rows = docs.select("doc_id", "text").collect()
    fps = [slow_fingerprint(r.text) for r in rows]
    want = grouped([r.doc_id for r in rows], fps)
    got = {r.doc_id: r for r in simhash_groups(docs).collect()}
    assert [got[r.doc_id].fingerprint for r in rows] == [f"{f:016x}" for f in fps]
    assert [got[r.doc_id].component_id for r in rows] == want
    assert sorted(r.doc_id for r in drop_near_copies(docs).collect()) == sorted(set(want))


@pytest.mark.parametrize("most,dense", [(2, 32), (2, 1), (1, 1), (3, 2), (4, 10)])
def test_links_of_crowded_buckets(spark, most, dense):
    rng = np.random.default_rng(most)
    fps = {0}
    for base in rng.integers(0, 1 << 63, 6).tolist():
        for _ in range(40):
            x = base
            for b in rng.integers(0, 64, rng.integers(0, 7)).tolist():
                x ^= 1 << b
            fps.add(x)
    signed = sorted(x - (1 << 64) if x >= 1 << 63 else x for x in fps)
    want = dict(zip(signed, grouped(signed, [x & (1 << 64) - 1 for x in signed], most)))
    links = close_links(spark.createDataFrame([(x,) for x in signed], "fp long"), most, dense)
    got = {r.id: r.component for r in components(links).collect()}
    assert {x: got.get(x, x) for x in signed} == want


def test_simhash_odd_rows(odd, none):
    got = simhash_groups(odd).collect()
    assert len(got) == odd.count() and {r.component_id for r in got if r.doc_id in (0, 1, 2)} == {0}
    assert {r.fingerprint for r in got if r.doc_id in (0, 1, 2)} == {"0" * 16}
    kept = drop_near_copies(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(3) == 1 and 4 not in ids and 0 in ids and 1 not in ids
    assert simhash_groups(none).count() == 0 and drop_near_copies(none).count() == 0


def test_components(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
    edges = [(k, k + 1) for k in range(0, 30)] + [(100, 90), (95, 90), (95, 95), (7, 7)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{k: 0 for k in range(31)}, 100: 90, 95: 90, 90: 90}


def exact(x, ids, k):
    out = {}
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        order = [int(c) for c in np.lexsort((ids, -s)) if c != q][:k]
        out[int(ids[q])] = [(int(ids[c]), float(s[c])) for c in order]
    return out


def test_neighbours(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = table.collect()
    x, ids = np.array([r.embedding for r in rows], dtype=float), np.array([r.vec_id for r in rows])
    want = exact(x, ids, 20)
    got: dict = {}
    for r in nearest_neighbours(table).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(want)
    hit = 0
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, len(found) + 1))
        assert all(s == pytest.approx(float(x[ids == q][0] @ x[ids == v][0]), abs=1e-12) for _, v, s in found)
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        hit += len({v for _, v, _ in found} & {v for v, _ in want[q]})
    assert hit >= 0.9 * sum(map(len, want.values()))


def test_neighbours_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [2.0, 1.0]), (20, [2.0, 1.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]),
            (6, [1.0, inf]), (7, [5.0, 5.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (9, [-1.0, -1.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, row string, id int")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in nearest_neighbours(df).collect())
    mine = [(7, 15.0), (20, 5.0), (0, 2.0), (9, -3.0)]
    assert got == sorted([(0, k + 1, v, s) for k, (v, s) in enumerate([(7, 5.0), (20, 2.0), (20, 2.0), (9, -1.0)])]
                         + [(20, k + 1, v, s) for k, (v, s) in enumerate(mine)] * 2)
    assert nearest_neighbours(df.limit(0)).count() == 0 and nearest_neighbours(df.where("vec_id = 0")).count() == 0


def test_language_held_out(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = identify(table).join(table.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == table.count()
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97 and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.rejected for r in rows]) < 0.02


def test_language_odd_rows(odd, none):
    got = identify(odd).collect()
    assert len(got) == odd.count()
    for r in got:
        if r.doc_id in (0, 1, 2, 9):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        else:
            assert r.lang_pred in ("en", "fr", "de")
    kept = keep_identified(odd)
    assert kept.columns == odd.columns and not {0, 1, 2, 9} & {r.doc_id for r in kept.collect()}
    assert identify(none).count() == 0 and keep_identified(none).count() == 0


def test_unlearned_text_is_rejected_among_short_documents(spark):
    rng = np.random.default_rng(3)
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang").collect()
    short = [r for r in table if 8 <= len((r.text or "").split()) < 400]
    rows = [(r.doc_id, r.text, r.lang if r.lang != "es" else None) for r in short]
    junk = [" ".join("".join(rng.choice(list("qxzjkvwbp"), rng.integers(3, 9))) for _ in range(40)) for _ in range(30)]
    rows += [(10_000_000 + k, text, None) for k, text in enumerate(junk)]
    lang = {r.doc_id: r.lang for r in short}
    got = identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    share = {name: np.mean([r.rejected for r in got if lang.get(r.doc_id, "junk") == name and (r.held_out or name in ("es", "junk"))])
             for name in ("en", "fr", "de", "es", "junk")}
    assert share["junk"] == 1 and share["es"] > 0.9, share
    assert max(share["en"], share["fr"], share["de"]) < 0.1 and min(share["en"], share["fr"], share["de"]) < 0.03, share


def test_floor_of_lengths_without_passages_and_of_small_languages():
    got = floors({"a": {1: [0.2] * 95 + [0.01] * 5, 4: [0.5] * 100}, "b": {1: [0.9], 4: [0.9]}, "c": {}}, 0.1)
    assert got[0].tolist() == pytest.approx([0.2] * 2 + [0.5] * 9)
    assert got[1].tolist() == got[2].tolist() and 0 < got[1][0] <= 0.2 and got[1][10] == pytest.approx(0.5)
    assert floors({"a": {}}, 0.1).tolist() == [[0.0] * 11]


def test_fingerprint_of_a_very_long_text():
    words = [f"w{k * k % 1009}" for k in range(200_000)]
    assert int.from_bytes(fingerprint(" ".join(words), 3), "big") == slow_fingerprint(" ".join(words[: 200_000]))
    assert fingerprint("a b", 3) == slow_fingerprint("a b").to_bytes(8, "big") and fingerprint(None, 3) == bytes(8)


def test_star_with_very_many_edges(spark):
    edges = spark.range(1, 20_000).selectExpr("0 AS u", "id AS v").union(spark.range(1, 50).selectExpr("30000 + id AS u", "30001 + id AS v"))
    got = {r.id: r.component for r in components(edges).collect()}
    assert all(got[k] == 0 for k in range(20_000)) and all(got[k] == 30_001 for k in range(30_001, 30_051))


def test_sample_of_a_repeated_identifier_is_bounded(spark):
    from fleetwarden.llm.langid import fit
    one = next(k for k in range(100, 200) if zlib.crc32(str(k).encode()) % 3 != 1)    # the model may learn from it
    rows = [(one, f"word{k % 3000} alpha beta gamma", "xx") for k in range(30_000)] + [(one, "the same text", "yy")] * 20_000
    rows += [(k, f"delta epsilon zeta {k}", "yy") for k in range(6, 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = fit(df, per_language=20)
    assert set(model.languages) == {"xx", "yy"}
    got = {r.doc_id: r.lang_pred for r in identify(df.where("doc_id < 100"), per_language=20).collect()}
    assert set(got.values()) == {"yy"}


def test_queries_are_dealt_and_far_lists_left_out(spark):
    """Small parts and chunks change nothing, and clustered lists that cannot matter are not visited."""
    rng = np.random.default_rng(5)
    centres = 10 * np.eye(8)[:6]
    v = centres[rng.integers(0, 6, 1500)] + rng.standard_normal((1500, 8)) * 0.1
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "vec_id long, embedding array<double>").repartition(4)
    key = lambda d: sorted(tuple(r) for r in d.select("query_id", "rank", "vec_id").collect())
    small = key(nearest_neighbours(df, k=5, chunk_rows=20, query_rows=3))
    assert small == key(nearest_neighbours(df, k=5))
    scores = v[::20] @ v.T
    scores[np.arange(75), np.arange(0, 1500, 20)] = -np.inf
    want = {(20 * q, int(x)) for q, row in enumerate(np.argsort(-scores, axis=1)[:, :5]) for x in row}
    assert len({(q, x) for q, _, x in small} & want) >= 0.95 * len(want)

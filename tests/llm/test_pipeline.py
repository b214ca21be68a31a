"""corpus_pipeline stage by stage against brute-force versions, and as a whole."""

import hashlib
from collections import Counter

import pytest

import corpus_pipeline as P
from fleetwarden.llm.common import written
from fleetwarden.llm.langid import identify
from fleetwarden.llm.queries import ORACLE
from tests.conftest import SF_SMALL

from .test_neighbours_and_language import grouped, slow_fingerprint
from .test_packing_sharding import leveled, packed_right

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, docs):
    out = [docs]
    for name, stage in P.STAGES:
        out.append(written(stage(spark, out[-1], SF_SMALL), f"test-{name}"))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_language_stage(stages):
    rejected = {r.doc_id for r in identify(stages[0]).collect() if r.rejected}
    assert stages[1].columns == COLUMNS and set(rows(stages[1])) == set(rows(stages[0])) - rejected
    assert len(rejected) < 0.03 * stages[0].count()


def test_line_stage(stages):
    import duckdb
    con = duckdb.connect()
    documents = stages[1].toPandas()  # noqa: F841  (read by the SQL)
    con.execute("CREATE TABLE documents AS SELECT * FROM documents")
    want = {d: (chars, sha) for d, _, gone, chars, sha in con.execute(
        f"SELECT doc_id, n_lines, n_dropped, kept_chars, kept_sha256 FROM ({ORACLE['op5_line_dedup']})").fetchall() if not gone or chars}
    got = {d: (r.n_chars, hashlib.sha256(r.text.encode()).hexdigest()) for d, r in rows(stages[2]).items()}
    blank = {d for d in want if d not in got}
    assert {d: v for d, v in want.items() if d not in blank} == got and stages[2].columns == COLUMNS
    assert all(not rows(stages[1])[d].text.strip() or want[d][0] < 400 for d in blank)


def test_near_dedup_stage(stages):
    before = sorted(rows(stages[2]).values(), key=lambda r: r.doc_id)
    ids = [r.doc_id for r in before]
    assert sorted(rows(stages[3])) == sorted(set(grouped(ids, [slow_fingerprint(r.text) for r in before])))
    assert stages[3].columns == COLUMNS


def test_mixing_stage(stages):
    size = {d: len((r.text or "").encode().split()) for d, r in rows(stages[3]).items()}
    source = {d: r.source for d, r in rows(stages[3]).items()}
    names = sorted(set(source.values()))
    total = [sum(n for d, n in size.items() if source[d] == s) for s in names]
    target = dict(zip(names, leveled(total, [(3, 1, 2)[k % 3] for k in range(len(names))])))
    taken = Counter(r.doc_id for r in stages[4].select("doc_id").collect())
    assert max(taken.values()) <= 2 and set(taken) <= set(size) and stages[4].columns == COLUMNS
    for s in names:
        mine = [d for d in size if source[d] == s]
        assert abs(sum(size[d] * taken[d] for d in mine) - target[s]) <= max(size[d] for d in mine) / 2 + 1e-6


def test_packing_stage(stages):
    out = stages[5].collect()
    n = packed_right(stages[4], out, 2048)
    assert n <= sum(r.length for r in out) / 2048 * 1.02 + 1
    docs = Counter(r.doc_id for r in stages[4].select("doc_id").collect())
    assert Counter(r.doc_id for r in out if r.piece == 0) == docs


def test_whole_run(spark, stages):
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = Counter(tuple(r) for r in P.run(spark, SF_SMALL).select(*key).collect())
    assert got == Counter(tuple(r) for r in stages[5].select(*key).collect())


def test_odd_rows_pass_all_stages(spark, odd, none):
    df = odd
    for name, stage in P.STAGES:
        before, df = df.columns, written(stage(spark, df, SF_SMALL), f"odd-{name}")
        assert name == "packing" or df.columns == before
    assert df.count() > 0
    df = none
    for _, stage in P.STAGES:
        df = written(stage(spark, df, SF_SMALL), "none")
    assert df.count() == 0

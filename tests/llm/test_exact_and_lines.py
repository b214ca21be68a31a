"""Exact dedup and line dedup against their SQL and on odd rows."""

import hashlib

import pytest

from fleetwarden.llm.exact_dedup import exact_dedup, merge_round
from fleetwarden.llm.line_dedup import dedup_lines
from fleetwarden.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tools.oracle_check import compare, duck

from .conftest import LINE


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    problems, *_ = compare(spark, duck(SF_SMALL), name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert not problems, problems


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_dedup_odd_rows(odd, keep):
    got = exact_dedup(odd, keep=keep).collect()
    assert len(got) == odd.count()
    same = [r for r in got if r.doc_id in (3, 4)]
    assert {r.group_size for r in same} == {3} and [r.kept for r in same].count(True) == 1
    assert {r.keep_id for r in same} == {4 if keep == "largest" else 3}
    assert {r.text_sha256 for r in got if r.doc_id in (0, 1)} == {hashlib.sha256(b"").hexdigest()}


def test_repeated_rows_keep_one(odd):
    got = exact_dedup(odd.where("doc_id = 3")).collect()
    assert len(got) == 2 and sum(r.kept for r in got) == 1


@pytest.mark.parametrize("fan_in,rounds", [(2, 1), (2, 5), (4, 2), (8, 1)])
def test_rounds_of_any_width(spark, fan_in, rounds):
    rows = [(k, f"Text {k % 37}" if k % 3 else "hot") for k in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    groups = {}
    for k, t in rows:
        groups.setdefault(t.lower(), []).append(k)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup(df, fan_in=fan_in, rounds=rounds).collect()}
    assert got == {k: (max(groups[t.lower()]), len(groups[t.lower()]), k == max(groups[t.lower()])) for k, t in rows}


def test_runs_are_exchanged_by_round_and_merged_in_order(spark):
    df = spark.createDataFrame([(f"{k % 40:04x}", k % 40 * 977, 5, k % 64, k, 1) for k in range(2000)], "digest string, check long, n_bytes int, run long, id long, n long")
    level = df.selectExpr("digest", "check", "n_bytes", "run", "struct(id AS rank, -id AS row) AS best", "n")
    before = 64
    for k in range(2):
        level = merge_round(level, k, 8)
        plan = spark._jvm.PythonSQLUtils.explainString(level._jdf.queryExecution(), "simple")
        assert "Exchange hashpartitioning(run" in plan and "Sort [run" in plan and "SortAggregate(key=[run" in plan
        assert plan.count("Exchange") == k + 1          # the runs' own exchange and no other
        rows = level.collect()
        assert len({(r.run, r.digest) for r in rows}) == len(rows) and sum(r.n for r in rows) == 2000
        assert max(sum(r.digest == d for r in rows) for d in {r.digest for r in rows}) <= before // 8
        before //= 8
    assert len(rows) == 40


def test_lines_with_varying_fields_stay_once(odd):
    got = {r.doc_id: r for r in dedup_lines(odd).collect()}
    assert got[None].text == f"{LINE} 17\nno identifier"  # rows without identifier come first
    assert got[5].text == "one of a kind" and got[6].text == "another thing\n" and got[7].text == "" and got[8].text == ""
    assert got[8].n_dropped == 2 and got[0].text is None and got[0].n_lines == 0 and got[1].text == ""
    assert got[10].n_dropped == 0 and got[5]._doc == 2


def test_edited_lines_share_a_template(spark):
    words = "one two three four five six seven eight nine ten".split()
    rows = [(k, " ".join([w if j != 5 else f"name{chr(97 + k)}" for j, w in enumerate(words)]) + f"\nrest {k}") for k in range(6)]
    got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].startswith("one two") and all(got[k] == f"rest {k}" for k in range(1, 6))


def test_empty_tables(none):
    assert exact_dedup(none).count() == 0 and dedup_lines(none).count() == 0


def cut_lines(spark, texts, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return [r.text for r in dedup_lines(df, **kw).orderBy("doc_id").collect()]


def test_distinct_rows_of_numbers_stay(spark):
    rows = ["0 3 1", "1 10 14", "7 7 7", "2 30 9", "12 1 5", "9 9 8", "total 12 30 45 9", "total 13 31 46 8", "total 1 2 3 4", "total 5 6 7 8", "2024-01-02 12:30 7.5"]
    texts = [f"{x}\ntext {chr(97 + k) * 5} of its own {chr(98 + k) * 4}" for k, x in enumerate(rows)]
    assert cut_lines(spark, texts) == texts
    assert cut_lines(spark, texts * 2)[: len(texts)] == texts   # copies: the first of each stays
    assert cut_lines(spark, ["1 2 3"] * 5) == ["1 2 3", "", "", "", ""]


def test_identical_lines(spark):
    long = " ".join(f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(40))
    texts = [f"a\n{long}", f"{long.replace(' ', '  ')}\nb", "c\nRead more", "d\nRead more", "e\nRead more", "}\nf", "}\n}", "}", "} "]
    got = cut_lines(spark, texts)
    assert got[:2] == [f"a\n{long}", "b"]                  # long: two documents are enough
    assert got[2:5] == texts[2:5]                           # short: three are not
    assert got[5:] == ["}\nf", "", "", ""]                  # four are, whatever the number of tokens
    assert cut_lines(spark, ["\n\n", "\n\n", " \n", "\n\t\n", "x\n\ny"]) == ["\n\n", "\n\n", " \n", "\n\t\n", "x\n\ny"]


def test_text_of_very_many_lines(spark):
    dull = "a line that stands on very many pages of this site"
    many = "\n".join(dull if k % 2 else f"line of its own {k:x}z{k}" for k in range(200_000))
    got = cut_lines(spark, [dull, many, "other"])
    assert got[0] == dull and got[1].count("\n") == 99_999 and dull not in got[1] and got[2] == "other"


@pytest.mark.parametrize("module,run", [("exact_dedup", exact_dedup), ("line_dedup", dedup_lines)])
def test_native_operators_run_no_python(spark, odd, monkeypatch, module, run):
    import importlib
    home, plans = importlib.import_module(f"fleetwarden.llm.{module}"), []
    kept = home.written

    def seen(df, name):
        plans.append(spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple"))
        return kept(df, name)
    monkeypatch.setattr(home, "written", seen)
    result = run(odd)
    plans.append(spark._jvm.PythonSQLUtils.explainString(result._jdf.queryExecution(), "simple"))
    assert len(plans) > 3
    for plan in plans:
        assert not any(x in plan for x in ("Python", "InPandas", "InArrow", "CartesianProduct", "NestedLoop")), plan

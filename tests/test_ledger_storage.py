"""Compacted ledgers, identity columns, the cascade along declared keys, SQL functions."""

import datetime as dt
import os
import tempfile

import pytest

from fleetwarden.operators import fleet
from fleetwarden.plans import standins as S
from fleetwarden.plans.views import index_run_script, register_functions
from fleetwarden.session import child_folders
from fleetwarden.sources import compaction as C
from fleetwarden.sources.identity import append_identified, identified, marks, positions

from .conftest import SF_SMALL

T = dt.datetime
RUNS = "fk_pk_id_db_j int, det_date long, det_clocking long, det_index_name string"


def runs(spark, *rows):
    return spark.createDataFrame(list(rows), RUNS)


def state(spark, path, ledger="run_ledger"):
    return sorted(tuple(r) for r in C.compacted_state(spark, path, ledger).drop("pk").collect())


def test_reads_base_and_open_batches_only(spark):
    path = tempfile.mkdtemp(prefix="fw-compact-")
    with pytest.raises(FileNotFoundError):
        C.compacted_state(spark, path, "run_ledger")
    C.append_batch(runs(spark, (1, 5, 0, "NIHIL"), (2, 5, 0, "NIHIL"), (None, 5, 0, "x")), path, "run_ledger", "b1", T(2024, 1, 1))
    want = [(1, 5, 0, "NIHIL"), (2, 5, 0, "NIHIL")]
    assert sorted(tuple(x) for x in C.compacted_state(spark, path, "run_ledger").drop("pk").where("fk_pk_id_db_j IS NOT NULL").collect()) == want
    assert C.compact(spark, path, "run_ledger") == 1
    C.append_batch(runs(spark, (2, 5, 9, "i"), (3, 6, 0, "NIHIL"), (None, 5, 1, "y")), path, "run_ledger", "b2", T(2024, 1, 2))
    got = C.compacted_state(spark, path, "run_ledger")
    assert not any("batch=b1" in f for f in got.inputFiles()) and any("batch=b2" in f for f in got.inputFiles())
    rows = {(r.fk_pk_id_db_j, r.det_date): (r.det_clocking, r.det_index_name) for r in got.collect()}
    assert rows == {(1, 5): (0, "NIHIL"), (2, 5): (9, "i"), (3, 6): (0, "NIHIL"), (None, 5): (1, "y")}
    # a late retry of the first batch changes nothing, before and after the next compaction
    C.append_batch(runs(spark, (1, 5, 0, "NIHIL"), (2, 5, 0, "NIHIL"), (None, 5, 0, "x")), path, "run_ledger", "b1", T(2024, 1, 1))
    same = {(r.fk_pk_id_db_j, r.det_date): (r.det_clocking, r.det_index_name) for r in C.compacted_state(spark, path, "run_ledger").collect()}
    assert same == rows
    assert C.compact(spark, path, "run_ledger") == 2 and C.compact(spark, path, "run_ledger") == 3
    assert child_folders(spark, f"{path}/deltas") == [] and child_folders(spark, f"{path}/base") == ["version=2", "version=3"]
    assert {(r.fk_pk_id_db_j, r.det_date): (r.det_clocking, r.det_index_name) for r in C.compacted_state(spark, path, "run_ledger").collect()} == rows


def test_compaction_that_was_cut_off(spark, monkeypatch):
    path = tempfile.mkdtemp(prefix="fw-cut-")
    C.append_batch(runs(spark, (1, 5, 0, "a")), path, "run_ledger", "b1", T(2024, 1, 1))
    C.compact(spark, path, "run_ledger")
    C.append_batch(runs(spark, (1, 5, 7, "b"), (2, 5, 0, "c")), path, "run_ledger", "b2", T(2024, 1, 2))

    def lost(*_):
        raise RuntimeError("driver lost between the base and its manifest")
    with monkeypatch.context() as m:
        m.setattr(C, "write_manifest", lost)
        with pytest.raises(RuntimeError):
            C.compact(spark, path, "run_ledger")
    assert os.path.exists(f"{path}/base/version=2") and C.manifest(spark, path).version == 1
    want = [(1, 5, 7, "b"), (2, 5, 0, "c")]
    assert state(spark, path) == want
    os.makedirs(f"{path}/manifests/version=2")                      # a manifest half written
    assert C.manifest(spark, path).version == 1 and state(spark, path) == want
    assert C.compact(spark, path, "run_ledger") == 2 and state(spark, path) == want


def test_insert_only_batches(spark):
    path = tempfile.mkdtemp(prefix="fw-errs-")
    err = lambda *rows: spark.createDataFrame(list(rows), "fk_pk_id_db_k string, err_label string, err_code string")
    C.append_batch(err(("1@5", "a", "x"), ("1@5", "a", "x"), ("2@5", "a", "y")), path, "run_errors", "b1", T(2024, 1, 1))
    for _ in range(2):
        C.compact(spark, path, "run_errors")
    C.append_batch(err(("1@5", "a", "x"), ("3@5", "b", "z")), path, "run_errors", "b2", T(2024, 1, 2))
    C.append_batch(err(("1@5", "a", "x"), ("2@5", "a", "y")), path, "run_errors", "b1", T(2024, 1, 1))   # b1 again
    want = [("1@5", "a", "x"), ("1@5", "a", "x"), ("2@5", "a", "y"), ("3@5", "b", "z")]
    assert state(spark, path, "run_errors") == want
    C.compact(spark, path, "run_errors")
    assert state(spark, path, "run_errors") == want


def test_identity_over_batches_and_retries(spark):
    path = tempfile.mkdtemp(prefix="fw-ident-")
    df = spark.createDataFrame([(k % 50, f"v{k % 7}") for k in range(500)] + [(3, "hot")] * 300, "a int, b string").repartition(5)
    schema = append_identified(df, path, "one", "id").schema
    first = sorted(tuple(r) for r in identified(spark, path, schema).collect())
    assert [r[0] for r in first] == list(range(1, 801)) and [r[1:] for r in first] == sorted(r[1:] for r in first)
    append_identified(df.limit(10), path, "two", "id")
    append_identified(df.repartition(3), path, "one", "id")            # a retry, dealt otherwise
    append_identified(df.limit(0), path, "none", "id")
    append_identified(df.limit(5), path, "three", "id")
    rows = sorted(tuple(r) for r in identified(spark, path, schema).collect())
    assert rows[:800] == first and [r[0] for r in rows] == list(range(1, 816))
    assert sorted((m.batch, m.first, m.n) for m in marks(spark, path).collect()) == [("none", 811, 0), ("one", 1, 800), ("three", 811, 5), ("two", 801, 10)]
    got = positions(df, ["a"]).select("a", "position").collect()
    assert sorted(r.position for r in got) == list(range(800)) and [a for _, a in sorted((r.position, r.a) for r in got)] == sorted(r.a for r in got)


def graph(spark, tables, keys, root, doomed, column):
    constraints = spark.createDataFrame(keys, fleet.CONSTRAINT)
    res = fleet.cascade_graph({k: spark.createDataFrame(rows, schema) for k, (rows, schema) in tables.items()}, constraints, root,
                              spark.createDataFrame([(x,) for x in doomed], f"{column} int"))
    return {k: sorted(r[0] for r in df.where("deleted").collect()) for k, df in res.items()}


def test_cascade_of_any_depth_and_several_ways(spark):
    tables = {"a": ([(k,) for k in range(6)], "id int"), "b": ([(10, 1), (11, 2), (12, None)], "id int, a int"),
              "c": ([(20, 1, 12), (21, 5, 10), (22, 5, 11), (23, None, None)], "id int, a int, b int"),
              "d": ([(30, 20), (31, 22), (32, 21)], "id int, c int"), "other": ([(1,)], "id int")}
    keys = [("b", "a", "a", "id"), ("c", "a", "a", "id"), ("c", "b", "b", "id"), ("d", "c", "c", "id")]
    got = graph(spark, tables, keys, "a", [1], "id")
    assert got == {"a": [1], "b": [10], "c": [20, 21], "d": [30, 32], "other": []}
    assert graph(spark, tables, keys, "b", [11], "id") == {"a": [], "b": [11], "c": [22], "d": [31], "other": []}
    assert not any(graph(spark, tables, keys, "a", [99], "id").values())


def test_cascade_of_a_table_that_references_itself(spark):
    tree = {"t": ([(1, None), (2, 1), (3, 2), (4, 3), (5, None), (6, 5), (7, 7)], "id int, up int"), "leaf": ([(50, 4), (51, 6)], "id int, t int")}
    keys = [("t", "up", "t", "id"), ("leaf", "t", "t", "id")]
    assert graph(spark, tree, keys, "t", [2], "id") == {"t": [2, 3, 4], "leaf": [50]}
    loop = [("x", "y", "y", "id"), ("y", "x", "x", "id")]
    with pytest.raises(ValueError):
        graph(spark, {"x": ([(1, 1)], "id int, y int"), "y": ([(1, 1)], "id int, x int")}, loop, "x", [1], "id")


def test_sql_functions_and_script(spark):
    snap = S.catalog_snapshot(spark, SF_SMALL)
    assert register_functions(spark, snap) == ["get_bloated_indexes", "bloated_index_worklist"]
    n = lambda q: spark.sql(f"SELECT count(*) FROM {q}").first()[0]
    assert n("get_bloated_indexes()") == n("get_bloated_indexes('corrected')") > 0 == n("get_bloated_indexes('other')")
    all_of, few = n("bloated_index_worklist(0)"), n("bloated_index_worklist(lowest => 60)")
    assert all_of >= n("bloated_index_worklist()") >= few
    plan = spark._jvm.PythonSQLUtils.explainString(spark.sql("SELECT * FROM get_bloated_indexes('corrected')")._jdf.queryExecution(), "simple")
    assert "reference" not in plan and "Union" not in plan             # the other report is not planned
    targets = snap.settings.select("db_id")
    rows = index_run_script(spark, snap, targets, 60.0).collect()
    assert {r.db_id for r in rows} == {r.db_id for r in targets.collect()}
    assert sum(not r.nothing_to_do for r in rows) == few and all(r.bloat_ratio_percent > 60 for r in rows if not r.nothing_to_do)


def test_fleet_runs_broadcast_small_sides_only_and_give_settings_back(spark):
    from fleetwarden.session import BROADCAST_CONF, FLEET_BROADCAST, small_broadcasts
    before = [spark.conf.get(k, None) for k in BROADCAST_CONF]
    with small_broadcasts(spark):
        assert [int(spark.conf.get(k)) for k in BROADCAST_CONF] == [FLEET_BROADCAST] * 2
    assert [spark.conf.get(k, None) for k in BROADCAST_CONF] == before


def test_kept_replies_are_cut_from_the_logs_once(spark):
    from fleetwarden.plans import registry
    cut = registry._slice(spark, "/root/testdata/sf0.001", keep=True)
    for name in ("ledger", "errors"):
        assert not any("events" in f for f in cut[name].inputFiles())
    again = registry._slice(spark, "/root/testdata/sf0.001")
    for name in ("ledger", "errors"):
        assert sorted(map(str, cut[name].collect())) == sorted(map(str, again[name].collect()))


def test_jobs_that_need_nothing_of_each_other_run_at_the_same_time(spark):
    import threading

    from fleetwarden.session import together
    both = threading.Barrier(2, timeout=60)
    assert together(spark, *[lambda k=k: (both.wait(), spark.range(k).count())[1] for k in (3, 5)]) == [3, 5]
    assert together(spark) == []
    with pytest.raises(ZeroDivisionError):
        together(spark, lambda: 1 // 0, lambda: 1)


def test_snapshots_and_actions_share_the_stored_parts(spark, tmp_path):
    from pyspark.sql import functions as F
    root, key = str(tmp_path), "p_partkey long, p_name string, p_size int"
    parts = [(k, f"part {k}", k % 50) for k in range(300)] + [(7, "part 7", 7), (7, "other 7", 8), (None, "none", 1), (97, "part 97", 3)]
    spark.createDataFrame(parts, key).write.parquet(f"{root}/part.parquet")
    spark.createDataFrame([(k % 290, float(k % 9)) for k in range(900)], "l_partkey long, l_quantity double").write.parquet(f"{root}/lineitem.parquet")
    spark.createDataFrame([(k, f"c {k}", "x") for k in range(20)], "c_custkey long, c_name string, c_mktsegment string").write.parquet(f"{root}/customer.parquet")
    before, after = S.catalog_snapshots(spark, root)
    for variant, snap in (("before", before), ("after", after)):
        fresh = S.catalog_snapshot(spark, root, variant, materialize=False)
        for name in ("pg_class", "pg_namespace", "pg_index", "pg_am", "pg_attribute", "pg_type", "pg_stats", "settings"):
            a, b = getattr(snap, name), getattr(fresh, name)
            assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect())), (variant, name)
    # as many rows as the catalogs' own keys pair, from two reads of the parts and one join
    cls = before.pg_class
    paired = (before.pg_index.select("db_id", "indexrelid", "indrelid")
              .join(cls.select("db_id", F.col("oid").alias("indexrelid"), F.col("relname").alias("index_name"), F.col("relnamespace").alias("oid")), ["db_id", "indexrelid"])
              .join(cls.select("db_id", F.col("oid").alias("indrelid"), F.col("relname").alias("tbl")), ["db_id", "indrelid"])
              .join(before.pg_namespace, ["db_id", "oid"]))
    acts = S.actions(spark, root)
    names = lambda df, c: sorted(map(repr, df.select("db_id", F.col(c[0]).alias("n"), "index_name").collect()))
    assert names(acts, ["schema_name"]) == names(paired, ["nspname"]) and acts.count() > len(parts)
    assert all("catalog-parts" in f for f in acts.inputFiles())

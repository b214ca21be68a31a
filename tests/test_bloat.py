"""Hand-computed cases for the bloat estimate (one database, hand-made catalogs)."""

import pytest

from fleetwarden.operators import bloat, catalog
from fleetwarden.sources.catalog import Snapshot


def snapshot(spark, indexes, block_size=8192, maxalign=8):
    """indexes: dicts with idx, tbl, schema, name, table, indkey, options, tuples, pages,
    cols=[(attname, index_def, null_frac, avg_width, typoid)], stats='table'|'index'|'none'."""
    cls, ns, idx, att, st, seen = [], {}, [], [], [], set()
    for i in indexes:
        nsp_oid = ns.setdefault(i.get("schema", "public"), 2200 + len(ns))
        cls.append((1, i["idx"], i["name"], nsp_oid, "i", 403, float(i.get("tuples", 0)), i.get("pages", 0),
                    i.get("options"), None, None, None))
        if i["tbl"] not in seen:
            seen.add(i["tbl"])
            cls.append((1, i["tbl"], i.get("table", "t"), nsp_oid, i.get("kind", "r"), 0, 0.0, 0,
                        i.get("tbl_options"), i.get("total", 100000), i.get("indexes", 10000), i.get("toast")))
        idx.append((1, i["idx"], i["tbl"], i.get("indkey", "1"), i.get("valid", True), i.get("primary", False)))
        for n, (attname, index_def, nf, width, typ) in enumerate(i["cols"], start=1):
            att.append((1, i["idx"], n, attname, typ, index_def))
            mode = i.get("stats", "table")
            if mode == "table":
                st.append((1, i.get("schema", "public"), i.get("table", "t"), index_def, nf, width))
            elif mode == "index":
                st.append((1, i.get("schema", "public"), i["name"], attname, nf, width))
    return Snapshot(
        pg_class=spark.createDataFrame(cls, "db_id long, oid long, relname string, relnamespace long, relkind string, "
                                            "relam long, reltuples double, relpages long, reloptions array<string>, "
                                            "total_bytes long, indexes_bytes long, toast_bytes long"),
        pg_namespace=spark.createDataFrame([(1, o, n) for n, o in ns.items()], "db_id long, oid long, nspname string"),
        pg_index=spark.createDataFrame(idx, "db_id long, indexrelid long, indrelid long, indkey string, "
                                            "indisvalid boolean, indisprimary boolean"),
        pg_am=spark.createDataFrame([(1, 403, "btree"), (1, 405, "hash")], "db_id long, oid long, amname string"),
        pg_attribute=spark.createDataFrame(att, "db_id long, attrelid long, attnum int, attname string, "
                                                "atttypid long, index_def string"),
        pg_type=spark.createDataFrame([(1, 19, "name"), (1, 20, "int8"), (1, 25, "text")],
                                      "db_id long, oid long, typname string"),
        pg_stats=spark.createDataFrame(st, "db_id long, schemaname string, tablename string, attname string, "
                                           "null_frac double, avg_width int"),
        settings=spark.createDataFrame([(1, block_size, maxalign)], "db_id long, block_size int, maxalign int"),
    )


BASE = dict(idx=10, tbl=100, name="t_c_idx", table="t", tuples=100000, pages=600,
            cols=[("c", "c", 0.0, 8, 20)])


def report(spark, **changes):
    return {r.index_name: r for r in bloat.bloat_report(snapshot(spark, [dict(BASE, **changes)])).collect()}


def measures(spark, fanout="reference", **changes):
    snap = snapshot(spark, [dict(BASE, **changes)])
    return bloat.bloat_measures(bloat.page_estimates(bloat.aligned_widths(bloat.index_widths(snap, fanout)))).first()


def test_hand_worked_case(spark):
    m = measures(spark)
    assert m.nulldatahdrwidth == 16
    assert (m.est_pages, m.est_pages_ff) == (247, 275)
    r = report(spark)["t_c_idx"]
    assert r.extra_ratio_percent == pytest.approx(58.8333, abs=1e-4)
    assert r.bloat_ratio_percent == pytest.approx(54.1667, abs=1e-4)
    assert r.bloat_size_bytes == 2662400 and r.live_data_size_bytes == 2252800
    assert r.bloat_ratio_factor == pytest.approx(2.1818, abs=1e-4)
    assert r.size == "4800 kB" and r.real_size_bytes == 4915200
    assert r.fillfactor == 90 and r.table_name == "t" and r.index_table_name == "t_c_idx(t)"
    assert r.is_na == "" and r.overridden_settings is False
    assert r.table_size_bytes == 90000


def test_two_columns_fanout(spark):
    two = dict(indkey="1 2", cols=[("a", "a", 0.0, 8, 20), ("b", "b", 0.0, 8, 20)])
    assert measures(spark, **two).nulldatahdrwidth == 40                     # each width counted twice
    assert measures(spark, fanout="corrected", **two).nulldatahdrwidth == 24


def test_header_nulls_and_missing_width(spark):
    assert measures(spark, cols=[("c", "c", 0.25, 8, 20)]).index_tuple_hdr_bm == 6
    m = measures(spark, cols=[("c", "c", None, None, 20)])
    assert m.index_tuple_hdr_bm == 2 and m.nulldatawidth == 1024


def test_half_even_rounding(spark):
    # width 4.5 -> rint 4 -> pad 4 -> 4.5 + 8 - 4 ; width 5.5 -> rint 6 -> pad 6
    assert measures(spark, cols=[("c", "c", 0.25, 6, 20)]).nulldatahdrwidth == 8 + 4.5 + 8 - 4
    assert measures(spark, cols=[("c", "c", 0.5, 11, 20)]).nulldatahdrwidth == 8 + 5.5 + 8 - 6


def test_zero_pages_and_unanalyzed(spark):
    r = report(spark, pages=0)["t_c_idx"]
    assert r.bloat_ratio_percent is None and r.extra_ratio_percent is None and r.size == "0 bytes"
    m = measures(spark, tuples=-1)
    assert m.est_pages == 1 and m.est_pages_ff == 1
    m0 = measures(spark, tuples=0)
    assert m0.est_pages == 1


def test_tuple_wider_than_page(spark):
    m = measures(spark, cols=[("c", "c", 0.0, 9000, 25)])
    assert m.est_pages is None and m.estimable is False
    r = report(spark, cols=[("c", "c", 0.0, 9000, 25)])["t_c_idx"]
    assert r.bloat_ratio_percent is None and r.bloat_size_bytes is None


def test_fillfactor_names_and_override(spark):
    r = report(spark, options=["fillfactor=70"], schema="app", name="i" * 51, tbl_options=["autovacuum_enabled=off"],
               cols=[("c", "c", 0.0, 8, 19)])["i" * 51]
    assert r.fillfactor == 70 and r.table_name == "app.t" and r.schema_name == "app"
    assert r.index_table_name == "i" * 50 + "…(app.t)" and r.overridden_settings is True and r.is_na == "TRUE"
    r50 = report(spark, name="j" * 50)["j" * 50]
    assert r50.index_table_name == "j" * 50 + "(t)"


def test_negative_bloat_is_null(spark):
    r = report(spark, pages=100)["t_c_idx"]
    assert r.bloat_ratio_percent is None and r.bloat_size_bytes == 0 and r.extra_size_bytes is None
    assert r.extra_ratio_percent < 0


def test_eligibility_filters(spark):
    def own(i, name, **kw):
        return dict(BASE, idx=i, tbl=100 + i, table=f"t{i}", name=name, **kw)
    snap = snapshot(spark, [dict(BASE), own(11, "p", primary=True), own(12, "v", valid=False),
                            own(13, "m", kind="m"), own(14, "sys", schema="pg_catalog"),
                            own(15, "nostats", stats="none"), own(16, "via_index", stats="index")])
    names = sorted(r.index_name for r in bloat.bloat_report(snap).collect())
    assert names == ["t_c_idx", "via_index"]


def test_or_join_counts_each_pair_once(spark):
    # a stats row that matches both branches (index named like its table, column def = name)
    snap = snapshot(spark, [dict(BASE, name="t", cols=[("c", "c", 0.0, 8, 20)])])
    st = catalog.index_stats(snap).collect()
    assert len(st) == 1 and st[0].branch == 1


def test_search_and_compare(spark):
    before = snapshot(spark, [dict(BASE), dict(BASE, idx=11, tbl=111, table="u", name="small", pages=300),
                              dict(BASE, idx=12, tbl=112, table="v", name="gone", pages=900)])
    after = snapshot(spark, [dict(BASE, pages=280), dict(BASE, idx=11, tbl=111, table="u", name="small", pages=300)])
    s = bloat.bloat_search(bloat.bloat_report(before, ordered=False), 24.99)
    got = [r.index_name for r in s.collect()]
    assert got == ["t_c_idx", "gone"]           # ascending ratio; 'small' is below the threshold
    cmp = {r.index_name: r for r in bloat.compare_bloat(s, bloat.bloat_report(after, ordered=False)).collect()}
    assert cmp["gone"].bloat_after == -333.0
    assert cmp["t_c_idx"].bloat_after == pytest.approx(100 * (280 - 275) / 280)


def test_an_index_run_estimates_its_target_databases_only(spark, monkeypatch):
    from pyspark.sql import functions as F

    from fleetwarden.plans import runs
    one = snapshot(spark, [dict(BASE), dict(BASE, idx=11, tbl=111, table="u", name="small", pages=300)])
    two = {k: df.unionByName(df.withColumn("db_id", F.lit(2).cast("long"))) for k, df in vars(one).items() if df is not None}
    fleet_of_two = Snapshot(**two)
    servers = spark.createDataFrame([(1, 5432, "h", 255)], "pk_id_conn int, conn_port int, conn_host string, switch_serv int")
    databases = spark.createDataFrame([(1, 1, "Public", "a", 255), (2, 1, "Public", "b", 0)],
                                      "pk_id_db int, fk_pk_id_conn int, db_scheme string, db_name string, switch_db int")
    estimated, report_of = [], bloat.bloat_report
    monkeypatch.setattr(bloat, "bloat_report", lambda snap, *a, **kw: estimated.append(
        {r.db_id for r in snap.pg_index.collect()}) or report_of(snap, *a, **kw))
    run = runs.reindex_run(servers, databases, fleet_of_two, fleet_of_two, "2024-01-15 01:00:00")
    assert [(r.db_id, r.index_name) for r in run["worklist"].collect()] == [(1, "t_c_idx")]
    assert [(r.fk_pk_id_db_j, r.det_index_name) for r in run["ledger"].collect()] == [(1, "t_c_idx")]
    assert estimated == [{1}, {1}]


def test_threshold_strict(spark):
    rep = spark.createDataFrame([(1, 24.99, "s", "t", "a"), (1, 24.990001, "s", "t", "b"), (1, None, "s", "t", "c")],
                                "db_id long, bloat_ratio_percent double, schema_name string, table_name string, "
                                "index_name string")
    assert [r.index_name for r in bloat.bloat_search(rep).collect()] == ["b"]


def test_sql_views(spark):
    from fleetwarden.plans.views import register_views
    snap = snapshot(spark, [dict(BASE), dict(BASE, idx=11, tbl=111, table="u", name="small", pages=300)])
    assert register_views(spark, snap) == ["get_bloated_indexes", "bloated_index_worklist"]
    r = spark.sql("SELECT index_name, size FROM get_bloated_indexes WHERE bloat_ratio_percent > 24.99").collect()
    assert [(x.index_name, x.size) for x in r] == [("t_c_idx", "4800 kB")]
    assert spark.sql("SELECT count(*) AS n FROM bloated_index_worklist").first().n == 1

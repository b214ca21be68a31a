from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetwarden.functions.flags import flag_bits, flag_is_set, flag_update
from fleetwarden.operators import fleet

MASKS = [128, 64, 32, 1]


def test_flag_properties(spark):
    df = spark.createDataFrame([(v,) for v in range(256)], "v int")
    for m in MASKS:
        rows = df.select(
            "v",
            flag_is_set(flag_update("v", m, "set"), m).alias("set_test"),
            flag_update(flag_update("v", m, "set"), m, "clear").alias("clear_set"),
            flag_update("v", m, "clear").alias("clear"),
            flag_update(flag_update("v", m, "toggle"), m, "toggle").alias("tt"),
        ).collect()
        for r in rows:
            assert r.set_test is True
            assert r.clear_set == r.clear
            assert r.tt == r.v


@settings(max_examples=25, deadline=None)
@given(st.integers(min_value=0, max_value=255), st.sampled_from(MASKS))
def test_flag_matches_python(spark, v, m):
    r = spark.range(1).select(flag_is_set(F.lit(v), m).alias("t"), flag_update(F.lit(v), m, "set").alias("s"),
                              flag_update(F.lit(v), m, "clear").alias("c"),
                              flag_update(F.lit(v), m, "toggle").alias("x")).first()
    assert r.t == ((v & m) == m)
    assert (r.s, r.c, r.x) == (v | m, v & ~m & 255, v ^ m)


def test_decode_and_filter(spark):
    df = spark.createDataFrame([(1, 0), (2, 255), (3, 128), (4, 32), (5, 160), (6, None)], "id int, sw int")
    rows = {r.id: r for r in fleet.decode_flags(df, "sw").collect()}
    assert rows[1].sw_bits == "00000000" and rows[2].sw_bits == "11111111"
    assert rows[3].reindex and not rows[3].log_reports
    assert rows[5].reindex and rows[5].log_reports and not rows[5].maintenance
    assert rows[6].sw_bits is None and rows[6].reindex is None
    assert sorted(r.id for r in fleet.with_flag(df, "sw", 128).collect()) == [2, 3, 5]
    assert sorted(r.id for r in fleet.with_flag(df, "sw", 32).collect()) == [2, 4, 5]


def test_boolean_switch(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, toggle_switch boolean")
    assert [r.id for r in fleet.with_flag(df, "toggle_switch", 128).collect()] == [1]


def test_update_where(spark):
    df = spark.createDataFrame([(1, 0), (2, 0)], "id int, sw int")
    out = fleet.update_flag(df, "sw", 32, "set", F.col("id") == 2).orderBy("id").collect()
    assert [r.sw for r in out] == [0, 32]
    assert spark.range(1).select(flag_bits(F.lit(32)).alias("b")).first().b == "00100000"


def test_targets_and_cascade(spark):
    servers = spark.createDataFrame([(1, 5432, "h1", 128), (2, 5433, "h2", 0), (3, 5434, "h3", 192)],
                                    "pk_id_conn int, conn_port int, conn_host string, switch_serv int")
    dbs = spark.createDataFrame([(10, 1, "Public", "a", 128), (11, 1, "Public", "b", 0), (12, 3, "s", "c", 255),
                                 (13, 9, "Public", "orphan", 128)],
                                "pk_id_db int, fk_pk_id_conn int, db_scheme string, db_name string, switch_db int")
    t = fleet.fleet_targets(servers, dbs).orderBy("db_id").collect()
    assert [(r.server_id, r.db_id) for r in t] == [(1, 10), (3, 12)]
    assert t[0].server_json == '{"Id_Conn":1,"port":5432,"host":"h1"}'
    assert t[0].database_json == '{"Id_Db":10,"Id_Conn":"1","Scheme":"Public","Name":"a"}'
    assert [r.pk_id_db for r in fleet.orphans(dbs, servers, "fk_pk_id_conn", "pk_id_conn").collect()] == [13]
    doomed = servers.filter(F.col("pk_id_conn") == 1)
    res = fleet.cascade_delete(servers, dbs, doomed)
    assert sorted(r.pk_id_db for r in fleet.deleted(res["databases"]).collect()) == [10, 11]
    assert sorted(r.pk_id_db for r in fleet.kept(res["databases"]).collect()) == [12, 13]
    summary = {(r.table_name, r.fate): r.n for r in fleet.cascade_summary(res).collect()}
    assert summary[("servers", "deleted")] == 1 and summary[("databases", "kept")] == 2


def test_enrolment_rows(spark):
    pgdb = spark.createDataFrame([(1, "postgres"), (1, "template0"), (1, "app"), (1, "O'Brien"), (2, "zeta")],
                                 "server_id int, datname string")
    rows = fleet.enrolment_rows(pgdb, server_id=1).collect()
    assert [r.db_name for r in rows] == ["app", "O'Brien"] or [r.db_name for r in rows] == ["app", "O'Brien"][::-1]
    assert rows[0].db_name == "app"  # descending by name ('a' > 'O')
    assert rows[1].statement.endswith("'O''Brien');")

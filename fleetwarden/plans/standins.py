"""Stand-in inputs shaped from the driver tables (supplier, customer, part, lineitem,
orders, events) with joins and column expressions only, so they grow with the scale
factor. Real deployments pass real snapshots / ledgers to the same operators.

The DuckDB oracle builds the same stand-ins from the same rules (``plans/oracle.py``).
"""

from __future__ import annotations

import os
import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwarden.session import scratch_path, stored, together
from fleetwarden.sources.catalog import Snapshot
from fleetwarden.sources.sinks import write_logs_by_day
from fleetwarden.sources.tables import read_table

# Parameters of the stand-in runs (arguments, not clocks).
RUN_TS = "2024-01-15 01:00:00"          # index-maintenance run time
EVENT_NOW = "2024-02-01 00:00:00"       # default time for event-log rows
EVENT_USER = "hub_user"                 # default user for event-log rows
HOST_DOMAIN = ".example.test"           # domain suffix of the invented host names
GRANTOR = "owner_a"
GRANTEE = "app_reader"
THRESHOLD = 24.99
ACL_REL = "alice=arwdDxt/owner_a;=r/owner_{};bob=U/owner_a;carol=a*r*/owner_a;broken=rw"
ACL_NSP = "app=UC/owner_a;=U/owner_a;ops=C*/owner_b;bob=X/owner_a;carol=U*C/owner_a"
ACL_PROC = "=X/owner_a;app=X*/owner_a;ops=X/owner_b;bob=r/owner_a"
ACL_DEFAULT = "app=arwdDxt/owner_a;=X/owner_a;ops=UC/owner_a;bob=a*/owner_b;eve=/owner_a"


_READS: dict[tuple, DataFrame] = {}


def _table(spark: SparkSession, d: str, name: str, columns: list[str]) -> DataFrame:
    """Driver-table scan, built once per session (the inputs are static test data, so the
    file listing and footer read need not be repeated for every query that uses them)."""
    key = (spark.sparkContext.applicationId, os.path.abspath(d), name, tuple(columns))
    if key not in _READS:
        _READS[key] = read_table(spark, d, name, columns)
    return _READS[key]


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


# ---------------------------------------------------------------- fleet
def servers(spark: SparkSession, d: str) -> DataFrame:
    s = _table(spark, d, "supplier", ["s_suppkey"])
    k = F.col("s_suppkey")
    return s.select(k.cast("int").alias("pk_id_conn"), (F.lit(5432) + k % 10).cast("int").alias("conn_port"),
                    F.concat(F.lit("db-"), _s(k), F.lit(HOST_DOMAIN)).alias("conn_host"),
                    (k * 37 % 256).cast("int").alias("switch_serv"))


def databases(spark: SparkSession, d: str) -> DataFrame:
    """Customers as databases; the server key wraps at (#suppliers + 1), so the last
    value has no server (orphans for the referential audit)."""
    n_servers = _table(spark, d, "supplier", ["s_suppkey"]).select(F.count(F.lit(1))).scalar()
    c = _table(spark, d, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    k = F.col("c_custkey")
    return c.select(k.cast("int").alias("pk_id_db"), (k % (n_servers + 1)).cast("int").alias("fk_pk_id_conn"),
                    F.when(k % 3 == 0, F.col("c_mktsegment")).otherwise(F.lit("Public")).alias("db_scheme"),
                    F.col("c_name").alias("db_name"), (k * 53 % 256).cast("int").alias("switch_db"))


def pg_ini(spark: SparkSession, d: str) -> DataFrame:
    s = servers(spark, d).select("pk_id_conn")
    k = F.col("pk_id_conn")
    a = s.filter(k % 7 != 0).select(k.alias("pk_id_pgini"), k.alias("fk_pk_id_conn"),
                                     F.lit("/opt/report").alias("path_pgbg"), F.lit("/srv/out").alias("path_out_dir"),
                                     F.lit("/srv/log/").alias("path_out_log_file"))
    b = s.filter(k % 5 == 0).select((k + 1000000).alias("pk_id_pgini"), k.alias("fk_pk_id_conn"),
                                     F.lit("/opt/report").alias("path_pgbg"), F.lit("/srv/out2").alias("path_out_dir"),
                                     F.lit("/srv/log2/").alias("path_out_log_file"))
    return a.unionByName(b)


def pg_database(spark: SparkSession, d: str) -> DataFrame:
    c = _table(spark, d, "customer", ["c_custkey", "c_name", "c_nationkey"])
    k = F.col("c_custkey")
    m = k % 50
    name = (F.when(m == 1, F.lit("postgres")).when(m == 2, F.lit("template0")).when(m == 3, F.lit("template1"))
            .when(m == 4, F.concat(F.lit("O'Brien db "), _s(k)))
            .when(m == 5, F.concat(F.lit("back\\slash_"), _s(k)))
            .otherwise(F.lower("c_name")))
    return c.select(F.col("c_nationkey").cast("int").alias("server_id"), name.alias("datname"))


# ---------------------------------------------------------------- catalog snapshot
def _loaded_parts(spark: SparkSession, d: str) -> DataFrame:
    """Every part with the number of its line items and their pages."""
    li = _table(spark, d, "lineitem", ["l_partkey", "l_quantity"])
    load = li.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        (F.count(F.lit(1)) * 1000).cast("double").alias("_tuples"),
        F.floor(F.sum("l_quantity") / 6).cast("long").alias("_pages"))
    return _table(spark, d, "part", ["p_partkey", "p_name", "p_size"]).join(load, "p_partkey", "left")


_LOADED: dict[tuple, DataFrame] = {}


def _stored_parts(spark: SparkSession, d: str) -> DataFrame:
    """The loaded parts, written once per session with the parts of a database together:
    both variants' catalogs derive from them, row by row or by small distinct sets."""
    key = (spark.sparkContext.applicationId, os.path.abspath(d))
    with _LOCK:
        if key not in _LOADED:
            p = _loaded_parts(spark, d).withColumn("db_id", _db_id(spark, d))
            _LOADED[key] = stored(p.hint("rebalance", "db_id").sortWithinPartitions("db_id"), "catalog-parts")
    return _LOADED[key]


def _db_id(spark: SparkSession, d: str) -> Column:
    n_databases = _table(spark, d, "customer", ["c_custkey"]).select(F.count(F.lit(1))).scalar()
    return F.floor(F.col("p_partkey") / 4).cast("long") % n_databases


def _index_rows(spark: SparkSession, d: str, variant: str, parts: DataFrame | None = None) -> DataFrame:
    p = _loaded_parts(spark, d).withColumn("db_id", _db_id(spark, d)) if parts is None else parts
    pk, sz = F.col("p_partkey"), F.col("p_size")
    tbl = F.floor(pk / 4).cast("long")
    p = p.withColumn("tbl", tbl)
    t = F.col("tbl")
    rp_before = F.when(pk % 37 == 1, F.lit(0)).otherwise(
        F.coalesce(F.col("_pages"), F.lit(0)) * (F.lit(1) + sz % 3) * (F.lit(1) + sz % 3)).cast("long")
    if variant == "after":
        p = p.filter(pk % 43 != 0)
        relpages = F.when(pk % 3 == 0, rp_before).otherwise(F.floor(rp_before / 2)).cast("long")
    else:
        relpages = rp_before
    nsp_oid = F.when(t % 29 == 1, F.lit(11)).when(t % 3 == 0, F.lit(2200)).otherwise(F.lit(16384) + t % 3)
    nspname = (F.when(t % 29 == 1, F.lit("pg_catalog")).when(t % 3 == 0, F.lit("public"))
               .otherwise(F.concat(F.lit("schema_"), _s(t % 3))))
    return p.select(
        "db_id", pk.alias("indexrelid"), (F.lit(1000000000) + t).alias("indrelid"), t.alias("tbl"),
        nsp_oid.cast("long").alias("nsp_oid"), nspname.alias("nspname"),
        F.concat(F.lit("t_"), _s(t)).alias("tblname"),
        F.concat(F.replace(F.col("p_name"), F.lit(" "), F.lit("_")), F.lit("_idx_"), _s(pk),
                 F.when(pk % 11 == 0, F.repeat(F.lit("x"), 45)).otherwise(F.lit(""))).alias("idxname"),
        F.when(sz % 3 == 0, F.lit("1")).when(sz % 3 == 1, F.lit("1 2")).otherwise(F.lit("1 2 3")).alias("indkey"),
        F.when(sz % 4 == 0, F.lit("fillfactor=70")).when(sz % 4 == 1, F.lit("fillfactor=100")).alias("idx_reloptions"),
        F.when(t % 6 == 0, F.lit("autovacuum_enabled=false")).alias("tbl_reloptions"),
        F.when(sz % 7 == 0, F.lit("hash")).otherwise(F.lit("btree")).alias("amname"),
        F.when(sz % 7 == 0, F.lit(405)).otherwise(F.lit(403)).cast("long").alias("am_oid"),
        (pk % 23 != 0).alias("indisvalid"), (pk % 5 == 0).alias("indisprimary"),
        F.when(t % 31 == 2, F.lit("m")).otherwise(F.lit("r")).alias("tbl_relkind"),
        F.when(pk % 41 == 3, F.lit(-1.0)).otherwise(F.coalesce(F.col("_tuples"), F.lit(-1.0))).alias("reltuples"),
        relpages.alias("relpages"),
        F.when(sz % 2 == 0, F.lit(0.0)).otherwise(F.lit(0.25)).alias("null_frac"),
        (F.lit(4) + sz % 29).cast("int").alias("avg_width"),
        (F.lit(8192) * (F.lit(64) + t % 1000) * 4).cast("long").alias("total_bytes"),
        (F.lit(8192) * (t % 64)).cast("long").alias("indexes_bytes"),
        F.when(t % 4 == 0, F.lit(None)).otherwise(F.lit(8192) * (t % 5)).cast("long").alias("toast_bytes"),
    )


def _index_column_rows(ix: DataFrame) -> DataFrame:
    n = F.col("n")
    return ix.withColumn("n", F.explode(F.sequence(F.lit(1), F.size(F.split("indkey", " "))))).select(
        "db_id", "indexrelid", "nspname", "tblname", "idxname", "null_frac", "avg_width",
        n.cast("int").alias("attnum"), F.concat(F.lit("col_"), _s(n)).alias("attname"),
        F.concat(F.lit("col_"), _s(n), F.lit("_"), _s("indexrelid")).alias("index_def"),
        F.when((F.col("indexrelid") + n) % 13 == 0, F.lit(19)).otherwise(F.lit(20)).cast("long").alias("atttypid"))


_WRITTEN: dict[tuple, Snapshot] = {}
_LOCK = threading.Lock()

#: Catalogs that take each of their rows from one part: in the order of the stored parts.
ROW_BY_ROW = ("pg_index", "pg_attribute", "pg_stats")


def catalog_snapshot(spark: SparkSession, d: str, variant: str = "before", materialize: bool = True) -> Snapshot:
    """Catalogs of the fleet: parts are indexes, four parts share a table, the tables are
    dealt over the customers, which are the fleet's databases.

    With ``materialize`` the snapshot is written once per session into the shared folder
    (parquet, partitioned by ``db_id``) and read back, like an exported catalog snapshot;
    the operators then plan against plain parquet scans."""
    if not materialize:
        return _catalog_snapshot(spark, d, variant)
    key = (spark.sparkContext.applicationId, os.path.abspath(d), variant)
    if key not in _WRITTEN:
        root = scratch_path(spark, f"catalog-{variant}")
        _catalog_snapshot(spark, d, variant, _stored_parts(spark, d)).write(root, clustered=ROW_BY_ROW)
        _WRITTEN[key] = Snapshot.read(spark, root)
    return _WRITTEN[key]


def catalog_snapshots(spark: SparkSession, d: str) -> tuple[Snapshot, Snapshot]:
    """The snapshots before and after the maintenance; neither needs the other."""
    before, after = together(spark, *[lambda v=v: catalog_snapshot(spark, d, v) for v in ("before", "after")])
    return before, after


def _catalog_snapshot(spark: SparkSession, d: str, variant: str = "before", parts: DataFrame | None = None) -> Snapshot:
    ix = _index_rows(spark, d, variant, parts)
    cols = _index_column_rows(ix)
    idx_rows = ix.select("db_id", F.col("indexrelid").alias("oid"), F.col("idxname").alias("relname"),
                         F.col("nsp_oid").alias("relnamespace"), F.lit("i").alias("relkind"),
                         F.col("am_oid").alias("relam"), "reltuples", "relpages",
                         F.split("idx_reloptions", ",").alias("reloptions"),
                         F.lit(None).cast("long").alias("total_bytes"), F.lit(None).cast("long").alias("indexes_bytes"),
                         F.lit(None).cast("long").alias("toast_bytes"))
    tbl_rows = (ix.select("db_id", F.col("indrelid").alias("oid"), F.col("tblname").alias("relname"),
                          F.col("nsp_oid").alias("relnamespace"), F.col("tbl_relkind").alias("relkind"),
                          "tbl_reloptions", "total_bytes", "indexes_bytes", "toast_bytes").distinct()
                .select("db_id", "oid", "relname", "relnamespace", "relkind", F.lit(0).cast("long").alias("relam"),
                        F.lit(0.0).alias("reltuples"), F.lit(0).cast("long").alias("relpages"),
                        F.split("tbl_reloptions", ",").alias("reloptions"), "total_bytes", "indexes_bytes",
                        "toast_bytes"))
    k = F.col("indexrelid")
    stats_cols = ["db_id", "schemaname", "tablename", "attname", "null_frac", "avg_width"]
    st = cols.filter(~((k % 7 == 0) & (F.col("attnum") == 3))).withColumns({
        "null_frac": F.when(k % 23 == 4, F.lit(None)).otherwise(F.col("null_frac")).cast("double"),
        "avg_width": F.when(k % 19 == 0, F.lit(None)).otherwise(F.col("avg_width")).cast("int")})
    st1 = st.filter((k % 2 == 0) | (k % 10 == 5)).select(
        "db_id", F.col("nspname").alias("schemaname"), F.col("tblname").alias("tablename"),
        F.col("index_def").alias("attname"), "null_frac", "avg_width")
    st2 = st.filter(k % 2 == 1).select(
        "db_id", F.col("nspname").alias("schemaname"), F.col("idxname").alias("tablename"), "attname",
        "null_frac", "avg_width")
    att = cols.select("db_id", F.col("indexrelid").alias("attrelid"), "attnum", "attname", "atttypid", "index_def")
    return Snapshot(
        pg_class=idx_rows.unionByName(tbl_rows),
        pg_namespace=ix.select("db_id", F.col("nsp_oid").alias("oid"), "nspname").distinct(),
        pg_index=ix.select("db_id", "indexrelid", "indrelid", "indkey", "indisvalid", "indisprimary"),
        pg_am=ix.select("db_id", F.col("am_oid").alias("oid"), "amname").distinct(),
        pg_attribute=att,
        pg_type=att.select("db_id", F.col("atttypid").alias("oid"),
                           F.when(F.col("atttypid") == 19, F.lit("name")).otherwise(F.lit("int8")).alias("typname"))
        .distinct(),
        pg_stats=st1.select(*stats_cols).unionByName(st2.select(*stats_cols)),
        settings=ix.select("db_id").distinct().select("db_id", F.lit(8192).alias("block_size"),
                                                      F.lit(8).alias("maxalign")),
    )


# ---------------------------------------------------------------- maintenance results
def run_databases(spark: SparkSession, d: str) -> DataFrame:
    """The databases whose catalogs were exported: those that an index run can cover."""
    exported = catalog_snapshot(spark, d).settings.select(F.col("db_id").alias("pk_id_db"))
    return databases(spark, d).join(exported, "pk_id_db", "left_semi")


def actions(spark: SparkSession, d: str) -> DataFrame:
    """What the maintenance reports for every index of the snapshot."""
    # an index's table and schema follow from its key, so the index row names them; the catalogs'
    # pairing of pg_index and pg_class rows remains (repeated keys), as do their key's nulls
    rows = _index_rows(spark, d, "before", _stored_parts(spark, d))
    ix = (rows.select("db_id", "indexrelid", "nspname", F.col("tblname").alias("tbl"))
          .join(rows.select("db_id", "indexrelid", F.col("idxname").alias("index_name")), ["db_id", "indexrelid"]))
    table = F.when(F.col("nspname") == "public", F.col("tbl")).otherwise(F.concat_ws(".", "nspname", "tbl"))
    bad = F.col("indexrelid") % 97 == 4
    return ix.select("db_id", F.col("nspname").alias("schema_name"), table.alias("table_name"), "index_name", (~bad).alias("ok"),
                     (F.length(table) + F.length("index_name")).cast("long").alias("seconds"),
                     F.when(bad, F.lit("index build failed")).alias("err_message"),
                     F.when(bad & (F.col("indexrelid") % 2 == 0), F.lit("duplicate key")).alias("err_detail"),
                     F.when(bad, F.lit("55000")).alias("err_code"))


def connect_failed(spark: SparkSession, d: str) -> DataFrame:
    return databases(spark, d).filter(F.col("pk_id_db") % 173 == 40).select(
        F.col("pk_id_db").alias("db_id"), F.lit("could not connect to server").alias("err_message"),
        F.lit("08001").alias("err_code"))


# ---------------------------------------------------------------- grants snapshot
def grants_snapshot(spark: SparkSession, d: str) -> Snapshot:
    """Relations from part, functions from customer, schemas from supplier, default
    privileges from orders; every object carries an ACL array in the catalog's text form."""
    s = _table(spark, d, "supplier", ["s_suppkey", "s_name"])
    sk = F.col("s_suppkey")
    m = sk % 10
    nsp = s.select((sk % 5).alias("db_id"), sk.alias("oid"),
                   F.when(m == 3, F.lit("pg_toast")).when(m == 7, F.lit("pgx_app"))
                   .when(m == 9, F.lit("information_schema")).when(m == 0, F.lit("public"))
                   .otherwise(F.lower("s_name")).alias("nspname"),
                   F.when(sk % 4 == 2, F.lit(None)).otherwise(F.split(F.lit(ACL_NSP), ";")).alias("nspacl"))
    p = _table(spark, d, "part", ["p_partkey", "p_name", "p_size"])
    pk, sz = F.col("p_partkey"), F.col("p_size")
    rel_acl = F.split(F.concat(F.lit(ACL_REL.split("{}")[0]),
                               F.when(pk % 2 == 0, F.lit("a")).otherwise(F.lit("b")),
                               F.lit(ACL_REL.split("{}")[1])), ";")
    cls = p.select(((pk % 10) % 5).alias("db_id"), (F.lit(1000) + pk).alias("oid"), (pk % 10).alias("relnamespace"),
                   F.when(pk % 3 == 0, F.concat(F.lit("t_"), _s(pk)))
                   .otherwise(F.concat(F.col("p_name"), F.lit(" "), _s(pk))).alias("relname"),
                   F.when(sz % 5 == 0, F.lit("r")).when(sz % 5 == 1, F.lit("S")).when(sz % 5 == 2, F.lit("v"))
                   .when(sz % 5 == 3, F.lit("m")).otherwise(F.lit("r")).alias("relkind"),
                   F.when(pk % 9 == 0, F.lit(None)).otherwise(rel_acl).alias("relacl"))
    c = _table(spark, d, "customer", ["c_custkey", "c_name"])
    ck = F.col("c_custkey")
    proc = c.select(((ck % 10) % 5).alias("db_id"), ck.alias("oid"),
                    F.when(ck % 6 == 0, F.col("c_name"))
                    .otherwise(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("_")))).alias("proname"),
                    (ck % 10).alias("pronamespace"),
                    F.when(ck % 3 == 0, F.lit("")).when(ck % 3 == 1, F.lit("integer"))
                    .otherwise(F.lit("text, bigint")).alias("identity_args"),
                    F.when(ck % 4 == 0, F.lit(None)).otherwise(F.split(F.lit(ACL_PROC), ";")).alias("proacl"))
    o = _table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderpriority"])
    ok = F.col("o_orderkey")
    om = ok % 5
    dacl = o.select((ok % 5).alias("db_id"),
                    F.when(F.col("o_custkey") % 2 == 0, F.lit("owner_a")).otherwise(F.lit("owner_b")).alias("role"),
                    F.lower("o_orderpriority").alias("nspname"),
                    F.when(om == 0, F.lit("r")).when(om == 1, F.lit("S")).when(om == 2, F.lit("f"))
                    .when(om == 3, F.lit("T")).otherwise(F.lit("n")).alias("objtype"),
                    F.when(ok % 7 == 0, F.lit(None)).otherwise(F.split(F.lit(ACL_DEFAULT), ";")).alias("defaclacl"))
    return Snapshot(pg_class=cls, pg_namespace=nsp, pg_proc=proc, pg_default_acl=dacl)


# ---------------------------------------------------------------- logs and slicing
def logs(spark: SparkSession, d: str) -> DataFrame:
    return logs_of(_table(spark, d, "events", ["user_id", "ts", "event_type", "props"]))


def logs_of(e: DataFrame) -> DataFrame:
    return e.select(F.col("user_id").cast("int").alias("server_id"), F.col("ts").alias("log_ts"),
                    F.concat(F.col("event_type"), F.lit(" "), F.col("props")).alias("line"))


_LOGS: dict[tuple, str] = {}


def logs_by_day(spark: SparkSession, d: str) -> DataFrame:
    """The logs as a collector keeps them: one folder a day, written once per session."""
    key = (spark.sparkContext.applicationId, os.path.abspath(d))
    if key not in _LOGS:
        path = scratch_path(spark, "catalog-logs")
        write_logs_by_day(logs(spark, d), path)
        _LOGS[key] = path
    return spark.read.parquet(_LOGS[key])


def log_files(spark: SparkSession, d: str) -> DataFrame:
    """One server log per server and day (csv for a quarter of the servers), a second .log
    file on a fifth of the servers and an upper-case .LOG file on a sixth."""
    lg = logs(spark, d)
    per_day = lg.groupBy("server_id", F.to_date("log_ts").alias("day")).agg(
        F.sum(F.length("line") + 1).cast("long").alias("size"), F.max("log_ts").alias("modification"),
        F.min("log_ts").alias("first_ts"))
    sid = F.col("server_id")
    main = per_day.select("server_id", F.when(sid % 4 == 3, F.lit("postgresql.csv"))
                          .otherwise(F.lit("postgresql.log")).alias("name"), "size", "modification")
    extra = per_day.filter(sid % 5 == 0).select("server_id", F.lit("postgresql-extra.log").alias("name"),
                                                F.lit(0).cast("long").alias("size"),
                                                F.col("first_ts").alias("modification"))
    upper = per_day.filter(sid % 6 == 1).select("server_id", F.lit("postgresql-old.LOG").alias("name"),
                                                F.lit(1).cast("long").alias("size"),
                                                F.col("first_ts").alias("modification"))
    return main.unionByName(extra).unionByName(upper)


def slice_runs(spark: SparkSession, d: str) -> DataFrame:
    """The schedule: a run after each two-hour window in which a server logged; a few
    minutes late depending on the server, and an hour later still on a fifth of them."""
    lg = logs(spark, d)
    sid = F.col("server_id")
    hours = F.floor(F.hour("log_ts") / 2) * 2 + 2 + F.when(sid % 5 == 0, F.lit(1)).otherwise(F.lit(0))
    minutes = (sid % 4) * 3
    run_ts = F.date_trunc("day", "log_ts").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), hours.cast("int"), minutes.cast("int"))
    return lg.select("server_id", run_ts.alias("run_ts")).distinct()


def call_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """What became of the slicer's remote call of each run and config row."""
    runs = slice_runs(spark, d).join(pg_ini(spark, d).select("pk_id_pgini", F.col("fk_pk_id_conn").alias("server_id")), "server_id")
    k = F.col("pk_id_pgini") * 7 + F.dayofyear("run_ts") * 5 + F.hour("run_ts")
    stage = (F.when(k % 29 == 3, F.lit("disconnect")).when(k % 67 == 7, F.lit("connect")).when(k % 23 == 5, F.lit("call"))
             .when(k % 19 == 11, F.lit("update")))
    return runs.select("server_id", "pk_id_pgini", "run_ts", stage.alias("stage"),
                       F.concat(stage, F.lit(" failed")).alias("err_message"),
                       F.when(k % 2 == 0, F.concat(F.lit("step "), stage)).alias("err_detail"),
                       F.when(stage.isNotNull(), F.lit("08006")).alias("err_code"),
                       F.when(stage.isNull(), k % 50).cast("long").alias("seconds"))


def events_in(spark: SparkSession, d: str) -> DataFrame:
    return events_of(_table(spark, d, "events", ["event_id", "ts", "user_id", "event_type", "props"]))


def events_of(e: DataFrame) -> DataFrame:
    et = F.col("event_type")
    return e.select(F.col("event_id").alias("id"),
                    F.when(et == "signup", F.lit(None)).otherwise(F.col("ts")).alias("event_date"),
                    F.when(et == "view", F.lit(None)).otherwise(_s("user_id")).alias("user_id"),
                    F.concat(et, F.lit(" "), F.col("props")).alias("description"))


def error_events(spark: SparkSession, d: str) -> DataFrame:
    e = _table(spark, d, "events", ["ts", "user_id", "event_type", "value", "props"])
    return e.filter(F.col("event_type") == "error").select(
        F.col("user_id").cast("int").alias("fk_pk_id_conn"), F.col("ts").alias("slice_now_ins"),
        F.col("props").alias("slice_err_mess"),
        F.when(F.col("value") >= 25, F.col("event_type")).alias("slice_err_detail"),
        F.get_json_object("props", "$.k").alias("slice_err_code"))

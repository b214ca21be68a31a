"""Fleet inventory: servers, their databases and the eight-bit switches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwarden.functions.flags import (BIT_LOG_REPORTS, BIT_MAINTENANCE, BIT_REINDEX, flag_bits,
                                         flag_is_set, flag_update)
from fleetwarden.functions.pgtext import quote_literal
from fleetwarden.session import stored

# Database names never offered for enrolment.
SYSTEM_DATABASES = ("postgres", "template0", "template1")
DEFAULT_DB_SCHEME = "Public"


def with_flag(df: DataFrame, col: str, mask: int) -> DataFrame:
    """Rows whose switch has every bit of ``mask`` set (boolean switches: true)."""
    return df.filter(flag_is_set(col, mask, df.schema[col].dataType))


def update_flag(df: DataFrame, col: str, mask: int, op: str, where=None) -> DataFrame:
    """Set / clear / toggle ``mask`` on the rows matching ``where`` (all rows if None)."""
    return df.withColumn(col, flag_update(col, mask, op, where))


def decode_flags(df: DataFrame, col: str) -> DataFrame:
    """The display bits plus one boolean per assigned position."""
    return df.select(
        "*",
        flag_bits(col).alias(f"{col}_bits"),
        flag_is_set(col, BIT_REINDEX).alias("reindex"),
        flag_is_set(col, BIT_MAINTENANCE).alias("maintenance"),
        flag_is_set(col, BIT_LOG_REPORTS).alias("log_reports"),
    )


def flag_counts(df: DataFrame, col: str, by: list[str] | None = None) -> DataFrame:
    """W3 summary: how many rows have each assigned bit (one partial+final aggregate)."""
    aggs = [F.count(F.lit(1)).alias("rows"),
            F.sum(flag_is_set(col, BIT_REINDEX).cast("long")).alias("reindex_rows"),
            F.sum(flag_is_set(col, BIT_MAINTENANCE).cast("long")).alias("maintenance_rows"),
            F.sum(flag_is_set(col, BIT_LOG_REPORTS).cast("long")).alias("log_report_rows")]
    return df.groupBy(*(by or [])).agg(*aggs)


# JSON objects keep their null members.
KEEP_NULLS = {"ignoreNullFields": "false"}


def fleet_targets(servers: DataFrame, databases: DataFrame, mask: int = BIT_REINDEX) -> DataFrame:
    """Flagged servers joined with their flagged databases.

    Both sides are filtered before the join; the join key is the server id, so Spark either
    broadcasts the (runtime-small) server side or co-partitions both on the key.
    ``server_json`` / ``database_json`` carry the same objects the hub passes around
    (the database object carries the server id as text).
    """
    s = with_flag(servers, "switch_serv", mask).select(
        F.col("pk_id_conn").alias("server_id"), "conn_port", "conn_host")
    d = with_flag(databases, "switch_db", mask).select(
        F.col("pk_id_db").alias("db_id"), F.col("fk_pk_id_conn").alias("server_id"), "db_scheme", "db_name")
    t = s.join(d, "server_id")
    return t.select(
        "server_id", "db_id", "conn_port", "conn_host", "db_scheme", "db_name",
        F.to_json(F.struct(F.col("server_id").alias("Id_Conn"), F.col("conn_port").alias("port"),
                           F.col("conn_host").alias("host")), KEEP_NULLS).alias("server_json"),
        F.to_json(F.struct(F.col("db_id").alias("Id_Db"), F.col("server_id").cast("string").alias("Id_Conn"),
                           F.col("db_scheme").alias("Scheme"), F.col("db_name").alias("Name")), KEEP_NULLS).alias("database_json"),
    )


def enrolment_rows(pg_database: DataFrame, server_id: int | None = None, ordered: bool = True) -> DataFrame:
    """Databases a server reports (minus system databases) as rows ready to enrol,
    with the insert statement text. ``server_id=None`` covers every server at once."""
    df = pg_database
    if server_id is not None:
        df = df.filter(F.col("server_id") == server_id)
    df = df.filter(~F.col("datname").isin(*SYSTEM_DATABASES))
    out = df.select(
        F.col("server_id").alias("fk_pk_id_conn"),
        F.col("datname").alias("db_name"),
        F.lit(DEFAULT_DB_SCHEME).alias("db_scheme"),
        F.lit(0).alias("switch_db"),
        F.concat(F.lit('INSERT INTO "DataBases" (pk_id_db, fk_pk_id_conn, switch_db, db_scheme, db_name) '
                       'VALUES (DEFAULT, '), F.col("server_id").cast("string"),
                 F.lit(", DEFAULT, DEFAULT, "), quote_literal("datname"), F.lit(");")).alias("statement"),
    )
    return out.orderBy(F.col("db_name").desc()) if ordered else out


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose foreign key has no parent (left anti join)."""
    return child.join(parent.select(F.col(pk).alias(fk)).distinct(), fk, "left_anti")


def _flag_deleted(df: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """``df`` with a ``deleted`` flag: a left join on the distinct doomed keys (no row
    duplication; the key side is small and broadcast by size when it can be)."""
    g = gone.select(key).distinct().withColumn("_gone", F.lit(True))
    return df.join(g, key, "left").withColumn("deleted", F.coalesce(F.col("_gone"), F.lit(False))).drop("_gone")


def kept(flagged: DataFrame) -> DataFrame:
    return flagged.filter(~F.col("deleted")).drop("deleted")


def deleted(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col("deleted")).drop("deleted")


def cascade_delete(servers: DataFrame, databases: DataFrame, doomed_servers: DataFrame,
                   ini: DataFrame | None = None, runs: DataFrame | None = None,
                   run_errors: DataFrame | None = None, slices: DataFrame | None = None,
                   slice_errors: DataFrame | None = None) -> dict[str, DataFrame]:
    """``ON DELETE CASCADE`` from servers down the hierarchy.

    ``doomed_servers`` holds ``pk_id_conn`` of the servers to delete. Returns, per table, the
    table with a boolean ``deleted`` column (``kept()`` / ``deleted()`` split it).
    Servers -> DataBases -> run ledger -> run errors; Servers -> pg_ini / slice ledger / slice errors.
    """
    ids = doomed_servers.select("pk_id_conn")
    out = {"servers": _flag_deleted(servers, ids, "pk_id_conn")}
    sid = ids.select(F.col("pk_id_conn").alias("fk_pk_id_conn"))
    out["databases"] = _flag_deleted(databases, sid, "fk_pk_id_conn")
    for name, df in (("pg_ini", ini), ("slice_ledger", slices), ("slice_errors", slice_errors)):
        if df is not None:
            out[name] = _flag_deleted(df, sid, "fk_pk_id_conn")
    if runs is not None:
        gone_db = deleted(out["databases"]).select(F.col("pk_id_db").alias("fk_pk_id_db_j"))
        out["run_ledger"] = _flag_deleted(runs, gone_db, "fk_pk_id_db_j")
        if run_errors is not None:
            gone_run = deleted(out["run_ledger"]).select(F.col("run_key").alias("fk_pk_id_db_k"))
            out["run_errors"] = _flag_deleted(run_errors, gone_run, "fk_pk_id_db_k")
    return out


# The hub's foreign keys, all of them ON DELETE CASCADE: child table, its column,
# parent table, the parent's key.
FOREIGN_KEYS = [
    ("databases", "fk_pk_id_conn", "servers", "pk_id_conn"),
    ("pg_ini", "fk_pk_id_conn", "servers", "pk_id_conn"),
    ("run_ledger", "fk_pk_id_db_j", "databases", "pk_id_db"),
    ("run_errors", "fk_pk_id_db_k", "run_ledger", "run_key"),
    ("slice_ledger", "fk_pk_id_conn", "servers", "pk_id_conn"),
    ("slice_errors", "fk_pk_id_conn", "servers", "pk_id_conn"),
]
CONSTRAINT = "child string, fk string, parent string, pk string"


def cascade_order(constraints: DataFrame, root: str) -> list[str]:
    """The tables that a deletion from ``root`` can reach, each after all tables on its
    longest way there: a recursive query over the constraints. A table that references
    itself is one step; other cycles are an error."""
    spark = constraints.sparkSession
    constraints.where("child <> parent").select("child", "parent").distinct().createOrReplaceTempView("_fk_edges")
    n = constraints.select("child").distinct().count()
    rows = spark.sql(f"""
        WITH RECURSIVE reach(tbl, depth) AS (
            SELECT '{root}', 0
            UNION ALL SELECT e.child, r.depth + 1 FROM reach r JOIN _fk_edges e ON e.parent = r.tbl WHERE r.depth <= {n})
        SELECT tbl, max(depth) AS depth FROM reach GROUP BY tbl""").collect()  # a row a table
    spark.catalog.dropTempView("_fk_edges")
    if any(r.depth > n for r in rows):
        raise ValueError("foreign keys in a cycle of several tables")
    return [r.tbl for r in sorted(rows, key=lambda r: (r.depth, r.tbl))]


def cascade_graph(tables: dict[str, DataFrame], constraints: DataFrame, root: str, doomed: DataFrame) -> dict[str, DataFrame]:
    """W6 for any schema: ``ON DELETE CASCADE`` along declared foreign keys.

    ``constraints`` (child, fk, parent, pk) is the schema; ``doomed`` holds the key values of
    the rows of ``root`` to delete (one column, named as in ``root``). Returns each table
    with a boolean ``deleted``. A row goes if any of its foreign keys names a deleted row, by
    whatever way; tables that the deletion cannot reach keep all rows. Null foreign keys
    name no row. A table that references itself is followed until no row is added.
    """
    declared = [r for r in constraints.select("child", "fk", "parent", "pk").collect() if r.child in tables and r.parent in tables]
    (root_key,) = doomed.columns
    out = {name: df.withColumn("deleted", F.lit(False)) for name, df in tables.items()}
    for name in cascade_order(constraints, root):
        if name not in tables:
            continue
        gone = [(root_key, doomed)] if name == root else []
        gone += [(c.fk, deleted(out[c.parent]).select(F.col(c.pk).alias(c.fk))) for c in declared if c.child == name and c.parent != name]
        out[name] = _flag_any(tables[name], gone)
        for c in declared:
            if c.child == name == c.parent:
                out[name] = _follow_self(out[name], c.fk, c.pk)
    return out


def _flag_any(df: DataFrame, gone: list[tuple[str, DataFrame]]) -> DataFrame:
    """``df`` with ``deleted``: whether any of the columns holds one of its doomed keys."""
    flagged = df.withColumn("deleted", F.lit(False))
    for k, (key, keys) in enumerate(gone):
        named = keys.select(F.col(key).alias(f"_key{k}")).where(F.col(f"_key{k}").isNotNull()).distinct()
        flagged = flagged.join(named, F.col(key) == F.col(f"_key{k}"), "left").select(
            *[F.col(f"`{c}`") for c in df.columns], (F.col("deleted") | F.col(f"_key{k}").isNotNull()).alias("deleted"))
    return flagged


def _follow_self(flagged: DataFrame, fk: str, pk: str) -> DataFrame:
    """Adds the rows whose ``fk`` names a deleted row of the same table, until none is added."""
    rows, before = stored(flagged, "cascade"), -1
    while (now := rows.where("deleted").count()) != before:
        before = now
        more = _flag_any(rows.drop("deleted"), [(fk, deleted(rows).select(F.col(pk).alias(fk)))])
        rows = stored(more.withColumnRenamed("deleted", "_more").join(
            deleted(rows).select(F.col(pk).alias("_was")).distinct(), F.col(pk) == F.col("_was"), "left")
            .withColumn("deleted", F.col("_more") | F.col("_was").isNotNull()).drop("_more", "_was"), "cascade")
    return rows


def cascade_summary(result: dict[str, DataFrame]) -> DataFrame:
    """Kept and deleted row counts per table: one conditional-count aggregate per table."""
    parts = []
    for name, flagged in result.items():
        agg = flagged.agg(F.count_if(~F.col("deleted")).alias("kept"), F.count_if(F.col("deleted")).alias("gone"))
        parts.append(agg.select(F.lit(name).alias("table_name"), F.explode(F.array(
            F.struct(F.lit("kept").alias("fate"), F.col("kept").alias("n")),
            F.struct(F.lit("deleted").alias("fate"), F.col("gone").alias("n")))).alias("_r"))
            .select("table_name", "_r.fate", "_r.n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

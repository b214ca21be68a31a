"""Catalog stages of the index-bloat estimate.

Every join key starts with ``db_id``: one snapshot holds the whole fleet and Spark
partitions the work by database and object id instead of looping over connections.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwarden.sources.catalog import Snapshot

# Fixed values.
BTREE = "btree"
EXCLUDED_SCHEMAS = ("information_schema", "pg_catalog")
DEFAULT_FILLFACTOR = 90
FILLFACTOR_PATTERN = "fillfactor=([0-9]+)"
OVERRIDE_PATTERN = "autovacuum"
NAME_TYPE_OID = 19          # oid of the ``name`` type (pg_catalog.name)
FANOUT_MODES = ("reference", "corrected")


def overridden_tables(snap: Snapshot) -> DataFrame:
    """Relations whose storage options mention autovacuum."""
    cls, nsp = snap.need("pg_class", "pg_namespace")
    c = (cls.filter(F.array_join("reloptions", ",").rlike(OVERRIDE_PATTERN))
         .select("db_id", F.col("oid").alias("table_id"), F.col("relname").alias("table_name"),
                 F.col("relnamespace"), F.array_join("reloptions", ",").alias("options")))
    n = nsp.select("db_id", F.col("oid").alias("relnamespace"), F.col("nspname").alias("scheme_name"))
    return c.join(n, ["db_id", "relnamespace"]).select("db_id", "table_id", "scheme_name", "table_name", "options")


def eligible_indexes(snap: Snapshot) -> DataFrame:
    """One row per valid, non-primary btree index on an ordinary table outside the system
    schemas, with the index's statistics, fill factor and the table's heap size.

    The namespace is the index's own. Filters sit on each catalog before its join, so they
    reach the parquet scans; ``pg_am`` and ``pg_namespace`` are tiny per database and are
    broadcast by Spark's size check, or else shuffled: they come after ``pg_class`` has met
    the indexes, which may be those of a few databases.
    """
    idx, cls, nsp, am = snap.need("pg_index", "pg_class", "pg_namespace", "pg_am")
    btree = am.filter(F.col("amname") == BTREE).select("db_id", F.col("oid").alias("relam"))
    i = (idx.filter(F.col("indisvalid") & (F.col("indisprimary") == F.lit(False)))
         .select("db_id", "indexrelid", "indrelid", "indkey"))
    ic = (cls.select("db_id", F.col("oid").alias("indexrelid"), F.col("relname").alias("idxname"),
                     "relnamespace", "relam", "reltuples", "relpages", F.col("reloptions").alias("idx_options")))
    tc = (cls.filter(F.col("relkind") == "r")
          .select("db_id", F.col("oid").alias("indrelid"), F.col("relname").alias("tblname"),
                  "total_bytes", "indexes_bytes", "toast_bytes"))
    ns = (nsp.filter(~F.col("nspname").isin(*EXCLUDED_SCHEMAS))
          .select("db_id", F.col("oid").alias("relnamespace"), "nspname"))
    j = (i.join(ic, ["db_id", "indexrelid"]).join(btree, ["db_id", "relam"], "left_semi")
         .join(tc, ["db_id", "indrelid"]).join(ns, ["db_id", "relnamespace"]))
    ff = F.nullif(F.regexp_extract(F.array_join("idx_options", " "), FILLFACTOR_PATTERN, 1), F.lit(""))
    return j.select(
        "db_id", F.col("indrelid").alias("tblid"), "nspname", "tblname", "idxname",
        F.col("reltuples").cast("double").alias("reltuples"), F.col("relpages").cast("long").alias("relpages"),
        "relam", "indrelid", "indexrelid", "indkey",
        F.coalesce(ff.cast("short").cast("int"), F.lit(DEFAULT_FILLFACTOR)).alias("fillfactor"),
        (F.col("total_bytes") - F.col("indexes_bytes") - F.coalesce(F.col("toast_bytes"), F.lit(0)))
        .cast("long").alias("table_size_bytes"),
    )


def index_columns(snap: Snapshot) -> DataFrame:
    """One row per key column of each eligible index (``indkey`` exploded)."""
    e = eligible_indexes(snap)
    x = e.select(*[c for c in e.columns if c != "indkey"], F.explode(F.split("indkey", " ")).alias("attnum"))
    return x.withColumn("attnum", F.col("attnum").cast("short"))


def attribute_pairs(snap: Snapshot, fanout: str = "reference", eligible: DataFrame | None = None) -> DataFrame:
    """Each eligible index attribute paired with the statistics rows it matches, carrying
    every column of the eligible index (used by W9 and W10).

    A stats row matches when it is in the index's schema and either describes the table
    column the index column is built from (table name + column definition, branch 1) or
    describes the index itself (index name + attribute name, branch 2). The disjunction
    becomes one equi-join: each attribute is exploded into its two ``(table, column)`` key
    forms and joined once on ``(db_id, schema, table, column)``. A branch-2 pair whose
    branch-1 condition also holds is dropped (null-safe), so each pair counts once.
    Attributes without statistics drop out (inner join).

    ``key_weight``: the catalog query pairs attributes with one row per *key column* of
    the index, so a k-column index counts every width k times. ``fanout='reference'``
    keeps that weight (without materialising the fan-out); ``'corrected'`` uses 1.
    """
    if fanout not in FANOUT_MODES:
        raise ValueError(f"fanout must be one of {FANOUT_MODES}")
    att, typ, st = snap.need("pg_attribute", "pg_type", "pg_stats")
    weight = F.size(F.split("indkey", " ")) if fanout == "reference" else F.lit(1)
    ix = (eligible if eligible is not None else eligible_indexes(snap)).withColumn("key_weight", weight)
    a = (att.filter(F.col("attnum") > 0)
         .select("db_id", F.col("attrelid").alias("indexrelid"), "attnum", "attname", "atttypid", "index_def")
         .join(ix, ["db_id", "indexrelid"])
         .join(typ.select("db_id", F.col("oid").alias("atttypid")), ["db_id", "atttypid"], "left_semi"))
    forms = F.explode(F.array(
        F.struct(F.lit(1).alias("branch"), F.col("tblname").alias("stats_table"), F.col("index_def").alias("stats_attname")),
        F.struct(F.lit(2).alias("branch"), F.col("idxname").alias("stats_table"), F.col("attname").alias("stats_attname"))))
    keyed = a.select("*", forms.alias("_k")).select("*", "_k.*").drop("_k")
    s = st.select("db_id", F.col("schemaname").alias("nspname"), F.col("tablename").alias("stats_table"),
                  F.col("attname").alias("stats_attname"), F.col("null_frac").cast("double").alias("null_frac"),
                  F.col("avg_width").cast("int").alias("avg_width"))
    both = F.coalesce((F.col("idxname") == F.col("tblname")) & (F.col("attname") == F.col("index_def")), F.lit(False))
    return (keyed.join(s, ["db_id", "nspname", "stats_table", "stats_attname"])
            .filter((F.col("branch") == 1) | ~both)
            .withColumn("is_name", F.col("atttypid") == NAME_TYPE_OID))


def index_stats(snap: Snapshot, fanout: str = "reference", eligible: DataFrame | None = None) -> DataFrame:
    """Attribute x statistics pairs (see ``attribute_pairs``)."""
    return attribute_pairs(snap, fanout, eligible).select(
        "db_id", "indexrelid", "attnum", "attname", "stats_table", "stats_attname", "null_frac", "avg_width",
        "is_name", "key_weight", "branch")

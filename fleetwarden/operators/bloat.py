"""B-tree index bloat estimate (W10-W16): tuple width, alignment, expected pages,
bloat measures, the 16-column report, the threshold search and the before/after check.

Each stage is a DataFrame -> DataFrame function of column expressions; no UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwarden.functions.pgtext import pg_size_pretty
from fleetwarden.operators.catalog import attribute_pairs, overridden_tables
from fleetwarden.sources.catalog import Snapshot

# Fixed values (PostgreSQL page layout and the procedure's defaults).
DEFAULT_BLOCK_SIZE = 8192
DEFAULT_MAXALIGN = 8
PAGE_HEADER = 24            # page header bytes
PAGE_OPAQUE = 16            # btree special space per page
ITEM_POINTER = 4            # line pointer per index tuple
HDR_NO_NULLS = 2            # index tuple header without a null bitmap
HDR_WITH_NULLS = 6          # 2 + (32 + 8 - 1) / 8 with integer division
DEFAULT_AVG_WIDTH = 1024    # width assumed for a column without statistics
DEFAULT_THRESHOLD = 24.99   # percent; an index is reported when strictly above
AFTER_MISSING = -333.0      # after-value when the index is gone or has no ratio
PUBLIC_SCHEMA = "public"
NAME_DISPLAY_CHARS = 50
ELLIPSIS = "…"


INDEX_KEYS = ["db_id", "indexrelid", "tblid", "nspname", "tblname", "idxname", "reltuples", "relpages",
              "fillfactor", "table_size_bytes"]


def index_widths(snap: Snapshot, fanout: str = "reference") -> DataFrame:
    """Per index, header size, summed data width and the ``name``-type flag.

    Grouped by the index identity plus its functionally dependent columns (as the catalog
    query groups), so the eligible-index set is computed once and nothing is joined back;
    the aggregate is partial before the shuffle, so a database holding a third of all
    indexes does not load one task.
    """
    pairs = attribute_pairs(snap, fanout)
    nf = F.coalesce(F.col("null_frac"), F.lit(0.0))
    w = pairs.groupBy(*INDEX_KEYS).agg(
        F.max(nf).alias("max_null_frac"),
        F.sum(F.col("key_weight") * (F.lit(1.0) - nf)
              * F.coalesce(F.col("avg_width"), F.lit(DEFAULT_AVG_WIDTH))).alias("nulldatawidth"),
        F.bool_or("is_name").alias("is_na"))
    if snap.settings is not None:
        w = w.join(snap.settings.select("db_id", "block_size", "maxalign"), "db_id", "left")
    else:
        w = w.withColumn("block_size", F.lit(None)).withColumn("maxalign", F.lit(None))
    return w.select(
        "db_id", "indexrelid", "tblid", F.col("nspname").alias("schema_name"), F.col("tblname").alias("table_name"),
        F.col("idxname").alias("index_name"), "reltuples", "relpages", "fillfactor", "table_size_bytes",
        F.coalesce(F.col("block_size"), F.lit(DEFAULT_BLOCK_SIZE)).cast("int").alias("bs"),
        F.coalesce(F.col("maxalign"), F.lit(DEFAULT_MAXALIGN)).cast("int").alias("maxalign"),
        F.when(F.col("max_null_frac") == 0, F.lit(HDR_NO_NULLS)).otherwise(F.lit(HDR_WITH_NULLS))
        .alias("index_tuple_hdr_bm"),
        F.col("nulldatawidth").cast("double").alias("nulldatawidth"),
        "is_na",
    )


def _pad(x: Column, m: Column) -> Column:
    r = x % m
    return F.when(r == 0, m).otherwise(r)


def aligned_widths(df: DataFrame) -> DataFrame:
    """Header and data width, each aligned up to ``maxalign``.
    The data width is rounded half-to-even before its remainder is taken."""
    m = F.col("maxalign")
    hdr = F.col("index_tuple_hdr_bm")
    w = F.col("nulldatawidth")
    data_pad = F.when(w == 0, F.lit(0)).otherwise(_pad(F.rint(w).cast("long"), m))
    return df.withColumn("nulldatahdrwidth",
                         (hdr + m - _pad(hdr, m)).cast("double") + w + m - data_pad)


def page_estimates(df: DataFrame) -> DataFrame:
    """Expected pages without and with the fill factor.

    ``1 + ceil(reltuples / floor(usable / (4 + tuple)))`` (0 when reltuples is NULL). When
    a tuple is wider than a page the floor is 0; the estimate is then NULL and
    ``estimable`` false instead of a division error or a made-up 100 % bloat.
    """
    usable = F.col("bs") - PAGE_OPAQUE - PAGE_HEADER
    per_tuple = F.lit(ITEM_POINTER) + F.col("nulldatahdrwidth")
    per_page = F.floor(usable / per_tuple)
    per_page_ff = F.floor(usable * F.col("fillfactor") / (F.lit(100.0) * per_tuple))

    def est(fit: Column) -> Column:
        return F.when(fit > 0, F.coalesce(F.lit(1) + F.ceil(F.col("reltuples") / fit), F.lit(0))).cast("double")

    return (df.withColumn("est_pages", est(per_page))
            .withColumn("est_pages_ff", est(per_page_ff))
            .withColumn("estimable", F.col("est_pages").isNotNull() & F.col("est_pages_ff").isNotNull()))


def bloat_measures(df: DataFrame) -> DataFrame:
    """Real size, extra size / ratio and bloat size / ratio."""
    bs, rp = F.col("bs").cast("long"), F.col("relpages")
    est, est_ff = F.col("est_pages"), F.col("est_pages_ff")
    return df.withColumns({
        "real_size": bs * rp,
        "extra_size": bs * (rp - est).cast("long"),
        "extra_ratio": F.when(rp == 0, F.lit(None)).otherwise(F.lit(100.0) * (rp - est) / rp).cast("double"),
        "bloat_size": F.when(est_ff.isNull(), F.lit(None))
                       .when(rp > est_ff, bs * (rp - est_ff)).otherwise(F.lit(0.0)).cast("double"),
        "bloat_ratio": F.when(rp == 0, F.lit(None)).otherwise(F.lit(100.0) * (rp - est_ff) / rp).cast("double"),
    })


def display_table(schema: Column, table: Column) -> Column:
    """``schema.table``, or just ``table`` in the public schema."""
    return F.concat(F.coalesce(F.concat(F.nullif(schema, F.lit(PUBLIC_SCHEMA)), F.lit(".")), F.lit("")), table)


def bloat_report(snap: Snapshot, fanout: str = "reference", ordered: bool = True) -> DataFrame:
    """The 16-column report (plus ``db_id``), largest bloat first, NULLs last."""
    m = bloat_measures(page_estimates(aligned_widths(index_widths(snap, fanout))))
    ot = overridden_tables(snap).select("db_id", F.col("table_id").alias("tblid"),
                                        F.lit(True).alias("_overridden"))
    m = m.join(ot, ["db_id", "tblid"], "left")
    real, bloat = F.col("real_size"), F.col("bloat_size")
    live = real - bloat
    tname = display_table(F.col("schema_name"), F.col("table_name"))
    name = F.col("index_name")
    out = m.select(
        "db_id",
        F.when(F.col("is_na"), F.lit("TRUE")).otherwise(F.lit("")).alias("is_na"),
        F.col("index_name"),
        F.coalesce(F.col("schema_name"), F.lit(PUBLIC_SCHEMA)).alias("schema_name"),
        tname.alias("table_name"),
        F.concat(F.substring(name, 1, NAME_DISPLAY_CHARS),
                 F.when(F.length(name) > NAME_DISPLAY_CHARS, F.lit(ELLIPSIS)).otherwise(F.lit("")),
                 F.lit("("), tname, F.lit(")")).alias("index_table_name"),
        real.alias("real_size_bytes"),
        pg_size_pretty("real_size").alias("size"),
        F.col("extra_ratio").alias("extra_ratio_percent"),
        F.when(F.col("extra_size") >= 0, F.col("extra_size")).alias("extra_size_bytes"),
        F.when(bloat >= 0, bloat).alias("bloat_size_bytes"),
        F.when(F.col("bloat_ratio") >= 0, F.col("bloat_ratio")).alias("bloat_ratio_percent"),
        F.when((bloat >= 0) & (live >= 0), real / F.nullif(live, F.lit(0.0))).alias("bloat_ratio_factor"),
        F.when(live >= 0, live).alias("live_data_size_bytes"),
        "fillfactor",
        F.coalesce(F.col("_overridden"), F.lit(False)).alias("overridden_settings"),
        "table_size_bytes",
    )
    return out.orderBy(F.col("bloat_size_bytes").desc_nulls_last()) if ordered else out


def bloat_search(report: DataFrame, threshold: float = DEFAULT_THRESHOLD, ordered: bool = True) -> DataFrame:
    """Indexes whose bloat ratio is strictly above ``threshold`` (NULL ratios drop)."""
    out = (report.filter(F.col("bloat_ratio_percent") > F.lit(float(threshold)))
           .select("db_id", "bloat_ratio_percent", "schema_name", "table_name", "index_name"))
    return out.orderBy("bloat_ratio_percent") if ordered else out


def compare_bloat(before: DataFrame, after_report: DataFrame) -> DataFrame:
    """Each searched index looked up again in the report taken after maintenance.
    A missing index or a NULL ratio gives -333."""
    keys = ["db_id", "schema_name", "table_name", "index_name"]
    a = after_report.select(*keys, F.col("bloat_ratio_percent").alias("_after"))
    return (before.select(*keys, F.col("bloat_ratio_percent").alias("bloat_before"))
            .join(a, keys, "left")
            .select(*keys, "bloat_before",
                    F.coalesce(F.col("_after"), F.lit(AFTER_MISSING)).alias("bloat_after")))

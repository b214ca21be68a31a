"""SQL access: the report functions as temporary views and as SQL table functions with
arguments, so that SQL users call them the way the hub's callers call its table function
(``SELECT ... FROM get_bloated_indexes()``), and the index run as a SQL script."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwarden.operators import bloat, grants
from fleetwarden.sources.catalog import Snapshot


def register_views(spark: SparkSession, catalog: Snapshot | None = None, acl: Snapshot | None = None,
                   grantor: str | None = None, grantee: str | None = None,
                   threshold: float = bloat.DEFAULT_THRESHOLD, fanout: str = "reference") -> list[str]:
    """Register ``get_bloated_indexes`` (the 16-column report plus ``db_id``),
    ``bloated_index_worklist`` (the threshold search) and, with an ACL snapshot and roles,
    ``grant_statements``. Views are lazy: each SQL query plans against the snapshots."""
    names = []
    if catalog is not None:
        report = bloat.bloat_report(catalog, fanout, ordered=False)
        report.createOrReplaceTempView("get_bloated_indexes")
        bloat.bloat_search(report, threshold, ordered=False).createOrReplaceTempView("bloated_index_worklist")
        names += ["get_bloated_indexes", "bloated_index_worklist"]
    if acl is not None and grantor and grantee:
        grants.grant_report(acl, grantor, grantee).createOrReplaceTempView("grant_statements")
        names.append("grant_statements")
    return names


def register_functions(spark: SparkSession, catalog: Snapshot) -> list[str]:
    """Registers the table functions ``get_bloated_indexes(how)``, the 16-column report plus
    ``db_id``, and ``bloated_index_worklist(lowest, how)``, the indexes with a bloat ratio
    above ``lowest``. ``how`` is ``reference`` (the default) or ``corrected``: of the two
    reports, Spark plans the one that is asked for."""
    reports = [bloat.bloat_report(catalog, how, ordered=False).withColumn("fanout", F.lit(how)) for how in ("reference", "corrected")]
    reports[0].unionByName(reports[1]).createOrReplaceTempView("bloat_reports")
    fields = [f for f in reports[0].schema if f.name != "fanout"]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION get_bloated_indexes(how STRING DEFAULT 'reference')
        RETURNS TABLE ({columns})
        RETURN SELECT {', '.join(f'`{f.name}`' for f in fields)} FROM bloat_reports WHERE fanout = how""")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION bloated_index_worklist(lowest DOUBLE DEFAULT {bloat.DEFAULT_THRESHOLD}D,
            how STRING DEFAULT 'reference')
        RETURNS TABLE (db_id BIGINT, bloat_ratio_percent DOUBLE, schema_name STRING, table_name STRING, index_name STRING)
        RETURN SELECT db_id, bloat_ratio_percent, schema_name, table_name, index_name FROM bloat_reports
            WHERE fanout = how AND bloat_ratio_percent > lowest""")
    return ["get_bloated_indexes", "bloated_index_worklist"]


#: The index run's search as a SQL script: the worklist of the databases that the run covers,
#: and how many of the run's databases have nothing to do. ``fleet_targets`` is a view of
#: the databases to be covered (``db_id``).
INDEX_RUN_SCRIPT = """
BEGIN
  DECLARE lowest DOUBLE DEFAULT CAST({threshold} AS DOUBLE);
  DECLARE how STRING DEFAULT '{how}';
  SELECT t.db_id, w.schema_name, w.table_name, w.index_name, w.bloat_ratio_percent,
         w.index_name IS NULL AS nothing_to_do
  FROM (SELECT DISTINCT db_id FROM fleet_targets) t
  LEFT JOIN bloated_index_worklist(lowest, how) w ON w.db_id = t.db_id;
END
"""


def index_run_script(spark: SparkSession, catalog: Snapshot, targets: DataFrame, threshold: float = bloat.DEFAULT_THRESHOLD,
                     how: str = "reference") -> DataFrame:
    """Registers what the script reads, runs it and returns its result."""
    register_functions(spark, catalog)
    targets.select("db_id").createOrReplaceTempView("fleet_targets")
    return spark.sql(INDEX_RUN_SCRIPT.format(threshold=float(threshold), how=how))

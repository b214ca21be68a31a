"""Catalog snapshots: the system catalogs of every enrolled database, one DataFrame per
catalog, each carrying ``db_id`` so one job covers the whole fleet (no per-database loop).

Expected columns (extra columns are ignored):

pg_class       db_id, oid, relname, relnamespace, relkind, relam, reltuples, relpages,
               reloptions array<string>, total_bytes, indexes_bytes, toast_bytes, relacl array<string>
pg_namespace   db_id, oid, nspname, nspacl array<string>
pg_index       db_id, indexrelid, indrelid, indkey (space separated), indisvalid, indisprimary
pg_am          db_id, oid, amname
pg_attribute   db_id, attrelid, attnum, attname, atttypid, index_def
pg_type        db_id, oid, typname
pg_stats       db_id, schemaname, tablename, attname, null_frac, avg_width
pg_proc        db_id, oid, proname, pronamespace, identity_args, proacl array<string>
pg_default_acl db_id, role, nspname, objtype, defaclacl array<string>
settings       db_id, block_size, maxalign
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession

from fleetwarden.session import path_exists, together

CATALOGS = ("pg_class", "pg_namespace", "pg_index", "pg_am", "pg_attribute", "pg_type", "pg_stats",
            "pg_proc", "pg_default_acl", "settings")


@dataclass(frozen=True)
class Snapshot:
    pg_class: DataFrame | None = None
    pg_namespace: DataFrame | None = None
    pg_index: DataFrame | None = None
    pg_am: DataFrame | None = None
    pg_attribute: DataFrame | None = None
    pg_type: DataFrame | None = None
    pg_stats: DataFrame | None = None
    pg_proc: DataFrame | None = None
    pg_default_acl: DataFrame | None = None
    settings: DataFrame | None = None

    @classmethod
    def read(cls, spark: SparkSession, root: str) -> "Snapshot":
        """Read the ``<root>/<catalog>/`` parquet folders that exist. A folder that exists
        but can't be read is an error, never an absent catalog."""
        paths = {name: f"{root}/{name}" for name in CATALOGS}
        return cls(**{name: spark.read.parquet(p) for name, p in paths.items() if path_exists(spark, p)})

    def write(self, root: str, mode: str = "overwrite", max_records_per_file: int = 5_000_000,
              clustered: tuple[str, ...] = ()) -> None:
        """Persist every present catalog as parquet, clustered by ``db_id``: rows of one
        database sit together (row-group statistics prune on ``db_id``) without one folder
        per database, which would mean one small file per database and writer task. File
        counts follow the size: the rebalance merges small databases and splits a hot one.
        Catalogs named in ``clustered`` come that way and are written as they are, without a
        shuffle. The catalogs are written at the same time."""
        present = {f.name: getattr(self, f.name) for f in fields(self) if getattr(self, f.name) is not None}

        def job(name: str, df: DataFrame):
            rows = df if name in clustered else df.hint("rebalance", "db_id").sortWithinPartitions("db_id")
            return lambda: rows.write.mode(mode).option("maxRecordsPerFile", max_records_per_file).parquet(f"{root}/{name}")
        if present:
            together(next(iter(present.values())).sparkSession, *[job(name, df) for name, df in present.items()])

    def with_(self, **changes) -> "Snapshot":
        return replace(self, **changes)

    def need(self, *names: str) -> list[DataFrame]:
        missing = [n for n in names if getattr(self, n) is None]
        if missing:
            raise ValueError(f"snapshot lacks catalogs: {missing}")
        return [getattr(self, n) for n in names]

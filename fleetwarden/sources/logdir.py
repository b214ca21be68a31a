"""Server log directories as a listing DataFrame (name, size, modification time).

Uses the ``binaryFile`` source with only metadata columns selected: Spark prunes the
``content`` column, so listing a directory never reads the log bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def list_log_dir(spark: SparkSession, path: str, server_id: int | None = None,
                 glob: str = "*") -> DataFrame:
    """One row per file: ``server_id, name, size, modification`` (UTC wall clock).

    Without ``server_id``, ``path`` may hold a ``server_id=<n>`` folder per server and one scan
    lists the whole fleet."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    sid = F.col("server_id") if server_id is None and "server_id" in df.columns else F.lit(server_id)
    return df.select(sid.cast("int").alias("server_id"), F.element_at(F.split("path", "/"), -1).alias("name"),
                     F.col("length").alias("size"), F.col("modificationTime").cast("timestamp_ntz").alias("modification"))


# The jsonlog record field holding the event time, wall clock and zone
# ("2024-03-01 12:00:00.123 UTC").
JSONLOG_TIME_FIELD = "$.timestamp"


def zoned_time(text: Column) -> Column:
    """The UTC wall clock of ``YYYY-MM-DD hh:mm:ss[.fraction] zone`` texts; the zone is an
    offset (``+03``, ``-0330``, ``+03:00``), ``UTC`` or a region name, UTC where absent. A
    text that is no time, or names an unknown zone, gives NULL."""
    zone = F.regexp_extract(text, r"^\S+ \S+ +(\S+)$", 1)
    clock = F.regexp_extract(text, r"^(\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?)", 1)
    offset = F.regexp_replace(F.regexp_replace(zone, r"^([+-]\d{2})$", "$1:00"), r"^([+-]\d{2})(\d{2})$", "$1:$2")
    return F.try_to_timestamp(F.concat(F.nullif(clock, F.lit("")), F.when(zone == "", F.lit("UTC")).otherwise(offset))).cast("timestamp_ntz")


def _jsonlog_records(df, *more: Column):
    return df.select(F.col("server_id").cast("int").alias("server_id"),
                     zoned_time(F.get_json_object("value", JSONLOG_TIME_FIELD)).alias("log_ts"),
                     F.col("value").alias("line"), *more)


def file_log_name() -> Column:
    """The name of a line's log file; files of either format go by the ``.log`` name."""
    return F.regexp_replace(F.col("_metadata.file_name"), r"\.(json|log)$", ".log").alias("log_name")


def only_named(df: DataFrame, names: list[str] | None) -> DataFrame:
    """The files of the given log names; a filter on file metadata, so that Spark lists the
    others and does not read them."""
    if names is None:
        return df
    return df.filter(F.col("_metadata.file_name").isin([n for name in names for n in (name, name.removesuffix(".log") + ".json")]))


def named_files(tasks: DataFrame) -> list[str]:
    """The log names that tasks ask for: one for each day of the week at most."""
    return sorted(r[0] for r in tasks.select("log_name").distinct().collect())


def untimed_lines(logs: DataFrame) -> DataFrame:
    """Lines per server whose time could not be read (they belong to no slice)."""
    return logs.groupBy("server_id").agg(F.count_if(F.col("log_ts").isNull()).alias("untimed"), F.count("*").alias("lines"))


def read_jsonlog(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    """Server logs written in PostgreSQL's ``jsonlog`` format, one record per line, laid out
    as ``<path>/server_id=<n>/...``. Read with the text source (files split across tasks;
    the raw line is kept, so slice sizes are byte-exact); the event time is parsed from each
    record's ``timestamp`` field with its zone (as UTC wall clock). Returns ``server_id, log_ts,
    line, log_name``; ``names`` (see ``named_files``) leaves the other files unread."""
    raw = only_named(spark.read.option("recursiveFileLookup", "false").text(path), names)
    return _jsonlog_records(raw, file_log_name())


def read_jsonlog_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """The same records as a file stream (new log files picked up as they appear); the
    ``server_id`` folder column needs the stream's schema to declare it."""
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType
    schema = StructType([StructField("value", StringType()), StructField("server_id", IntegerType())])
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).text(path)
    return _jsonlog_records(s)


# A stderr log record starts with its time ("2024-03-01 12:00:00.123 UTC [42] LOG: ...");
# lines without it continue the previous record.
STDERR_TIME_PATTERN = (r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(?:\.\d{1,6})?"
                       r"(?: (?:[+-]\d{2}(?::?\d{2})?|[A-Z][A-Za-z]+(?:/[A-Za-z_]+)?)(?= |$))?)")


def _fill_split_times(batches):
    """Per task, in file order: give each continuation line the time of the record it
    continues. State (the last time seen in the current file split) carries across Arrow
    batches; lines before a split's first record are marked ``_lead`` for the fix-up."""
    import pandas as pd
    key, last = None, None
    for pdf in batches:
        split = pdf["_file"].astype(str) + "#" + pdf["_start"].astype(str)
        new_split = split.ne(split.shift())
        if len(pdf):
            new_split.iloc[0] = split.iloc[0] != key
        group = new_split.cumsum()
        filled = pdf["_ts"].groupby(group).ffill()
        if len(pdf) and not new_split.iloc[0]:      # first group continues the previous batch's split
            first = group == group.iloc[0]
            filled = filled.where(~first | filled.notna(), last)
        pdf = pdf.assign(log_ts=filled, _lead=filled.isna())
        if len(pdf):
            key = split.iloc[-1]
            tail = filled[group == group.iloc[-1]].dropna()
            continues = (group.iloc[-1] == group.iloc[0]) and not new_split.iloc[0]
            if len(tail):
                last = tail.iloc[-1]
            elif not continues:       # the batch ends inside a new split that has no record yet
                last = None
        yield pdf.drop(columns=["_ts"]).assign(log_ts=pd.to_datetime(pdf["log_ts"]))


def read_stderr_log(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    """Server logs in PostgreSQL's plain ``stderr`` format under ``<path>/server_id=<n>/``.
    Returns ``server_id, log_ts, line, log_name``; a continuation line keeps its own text and
    carries the time of the record it belongs to, so it is sliced with that record. The text
    goes through Python once; ``names`` (see ``named_files``) leaves the other files unread."""
    raw = (only_named(spark.read.text(path), names)
           .select("value", file_log_name(), F.col("server_id").cast("int").alias("server_id"),
                   F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
                   zoned_time(F.regexp_extract("value", STDERR_TIME_PATTERN, 1)).alias("_ts")))
    # lines ahead of a split's first record continue the last record of the earlier splits
    # of the same file (times in a log file do not decrease): one small row per split
    # (natively, from the parsed times); ahead of a file's first record, its first time
    per_split = raw.groupBy("_file", "_start").agg(F.max("_ts").alias("_last"), F.min("_ts").alias("_first"))
    w = Window.partitionBy("_file")
    before = w.orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_split.select("_file", "_start", F.coalesce(F.max("_last").over(before), F.min("_first").over(w)).alias("_carry"))
    schema = "value string, log_name string, server_id int, _file string, _start long, log_ts timestamp_ntz, _lead boolean"
    filled = raw.mapInPandas(_fill_split_times, schema).join(carry, ["_file", "_start"], "left")
    return filled.select("server_id", F.when(F.col("_lead"), F.col("_carry")).otherwise(F.col("log_ts")).alias("log_ts"),
                         F.col("value").alias("line"), "log_name")

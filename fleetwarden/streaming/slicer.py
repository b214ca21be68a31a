"""W29 in full: the two-hour run as a stream, from log lines to replies, ledger and errors.

Spark's own stateful operators drop a line that comes after the watermark before any code
sees it. Here late lines are rows of their own, so the state is kept by the stream: line
counts, bytes and times for each (server, hour) that an open window can still need. It holds
a few small rows a server, and every step on it is a join or an aggregate over the whole
fleet.

A micro-batch

1. aggregates its lines to hours (partially before the shuffle), which gives the new
   watermark: the latest line less the allowed delay;
2. gives out lines that belong to windows closed by an earlier batch as late rows;
3. joins the scheduled tasks (servers, config rows, schedule: static tables) whose windows
   the new watermark closes with the hours, and settles them as the batch run does;
4. keeps the hours that open windows need.

A batch reads the state its predecessor left and writes its own folders only, so that a
replayed batch gives the same rows; its commit record comes last (see ``commits``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetwarden.functions.flags import BIT_LOG_REPORTS
from fleetwarden.functions.slicewin import SLICE_HOURS, effective_end
from fleetwarden.operators import slicing
from fleetwarden.plans.runs import settle_tasks
from fleetwarden.session import delete_path, ensure_utc, stored
from fleetwarden.streaming.commits import begin, commit, committed, marks, write_output

HOURS = "server_id int, hour timestamp_ntz, line_count long, slice_bytes long, first_ts timestamp_ntz, last_ts timestamp_ntz"
LATE = "server_id int, window_start timestamp_ntz, window_end timestamp_ntz, end_inclusive boolean, log_ts timestamp_ntz, line string"


def hours_of(logs: DataFrame) -> DataFrame:
    """Line count, bytes and first and last time of each server and hour."""
    hour = F.date_trunc("hour", "log_ts").cast("timestamp_ntz").alias("hour")
    return logs.where(F.col("log_ts").isNotNull()).groupBy("server_id", hour).agg(
        F.count(F.lit(1)).alias("line_count"), F.sum(F.octet_length("line") + 1).cast("long").alias("slice_bytes"),
        F.min("log_ts").alias("first_ts"), F.max("log_ts").alias("last_ts"))


def merged_hours(*parts: DataFrame) -> DataFrame:
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.groupBy("server_id", "hour").agg(
        F.sum("line_count").alias("line_count"), F.sum("slice_bytes").alias("slice_bytes"),
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))


def _closing(tasks: DataFrame, after: dt.datetime | None, upto: dt.datetime) -> DataFrame:
    end = effective_end(F.col("window_end"), F.col("end_inclusive"))
    closed = tasks.where(end <= F.lit(upto).cast("timestamp_ntz"))
    return closed if after is None else closed.where(end > F.lit(after).cast("timestamp_ntz"))


class SliceLedgerStream:
    """The slicer as a stream over log lines (``server_id, log_ts, line``).

    ``inputs`` is called for each micro-batch and returns the hub's tables as they are then:
    ``servers``, ``ini``, ``schedule`` (server_id, run_ts), ``files`` (the log listing) and,
    where calls can fail, ``call_outcomes``.
    """

    def __init__(self, spark: SparkSession, inputs: Callable[[], dict[str, DataFrame]], out: str, delay: dt.timedelta = dt.timedelta(minutes=10),
                 strip_domain: str | None = None, scheme: str = "slicer") -> None:
        ensure_utc(spark)
        self.spark, self.inputs, self.out, self.delay = spark, inputs, out, delay
        self.strip_domain, self.scheme = strip_domain, scheme

    def watermark(self, batch_id: int) -> dt.datetime | None:
        """What batch ``batch_id`` left as its watermark."""
        row = marks(self.spark, self.out).where(F.col("batch") == batch_id).first()
        return row.watermark if row else None

    def _hours(self, batch_id: int) -> DataFrame:
        return self.spark.read.schema(HOURS).parquet(f"{self.out}/hours/batch={batch_id}")

    def write_batch(self, lines: DataFrame, batch_id: int) -> None:
        spark, out = self.spark, self.out
        begin(spark, out, batch_id)
        before = self.watermark(batch_id - 1)
        new = stored(hours_of(lines), "hours")
        last = new.agg(F.max("last_ts")).first()[0]
        now = max((t for t in (before, last and last - self.delay) if t), default=None)
        known = merged_hours(new, self._hours(batch_id - 1)) if batch_id and before else new
        if now is None:
            write_output(known, out, "hours", batch_id)
            return commit(spark, out, batch_id)
        given = self.inputs()
        tasks = slicing.slice_tasks(given["servers"], given["ini"], given["schedule"], BIT_LOG_REPORTS, self.strip_domain)
        if before is not None:
            self._write_late(lines, new, _closing(tasks, None, before), batch_id)
        called = stored(slicing.reached_tasks(_closing(tasks, before, now), given.get("call_outcomes")), "tasks")
        made = slicing.calls_made(called)
        settled = settle_tasks(called, slicing.report_of_hours(known, made), slicing.log_listing(given["files"], tasks=made),
                               given.get("call_outcomes") is not None, self.scheme)
        for name in ("ledger", "errors", "replies"):
            write_output(settled[name], out, name, batch_id)
        needed = F.col("hour") >= F.lit(now - dt.timedelta(hours=SLICE_HOURS + 1)).cast("timestamp_ntz")
        write_output(known.where(needed), out, "hours", batch_id)
        commit(spark, out, batch_id, now)
        delete_path(spark, f"{out}/hours/batch={batch_id - 2}")

    def _write_late(self, lines: DataFrame, new: DataFrame, closed: DataFrame, batch_id: int) -> None:
        """Lines of windows that an earlier batch closed, once for each such window. The
        lines are read a second time only where the hours say that there are any."""
        span = new.agg(F.min("first_ts").alias("a"), F.max("last_ts").alias("b")).first()
        if span.a is None:
            return
        end = effective_end(F.col("window_end"), F.col("end_inclusive"))
        a, b = (F.lit(x).cast("timestamp_ntz") for x in span)
        closed = stored(closed.where((end > a) & (F.col("window_start") <= b)), "closed")
        if closed.isEmpty():
            return
        write_output(slicing.slice_rows(lines, closed), self.out, "late", batch_id)

    def start(self, log_stream: DataFrame, checkpoint: str, processing_time: str | None = None) -> StreamingQuery:
        """Drains what is there and stops, or keeps running with ``processing_time`` triggers."""
        w = log_stream.writeStream.foreachBatch(self.write_batch).option("checkpointLocation", checkpoint)
        return (w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)).start()

    def late_lines(self) -> DataFrame:
        """Late lines per server and window: how many, and from when to when."""
        late = committed(self.spark, self.out, "late", LATE)
        return late.groupBy(*slicing.WINDOW_KEY).agg(F.count("*").alias("late_lines"), F.min("log_ts").alias("first_ts"), F.max("log_ts").alias("last_ts"))

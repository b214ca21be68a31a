"""The two-hour schedule as event-time tumbling windows.

Each run of the batch slicer cuts ``[hour - 2h, hour)`` once that window has closed; the
stream does the same continuously: a window per server is emitted (append mode) once the
watermark passes its end, and its state is dropped. Late lines beyond the watermark are
not added to an already emitted window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetwarden.session import ensure_utc

SLICE_WIDTH = "2 hours"
DEFAULT_WATERMARK = "10 minutes"
OUT_COLS = ["server_id", "window_start", "window_end", "line_count", "slice_bytes", "first_ts", "last_ts"]


def _aggs():
    return [F.count(F.lit(1)).alias("line_count"),
            F.sum(F.octet_length("line") + 1).cast("long").alias("slice_bytes"),
            F.min("log_ts").alias("first_ts"), F.max("log_ts").alias("last_ts")]


def slice_windows(logs: DataFrame, width: str = SLICE_WIDTH) -> DataFrame:
    """Batch twin: every two-hour window of every server (closed or not)."""
    g = logs.groupBy("server_id", F.window("log_ts", width).alias("w")).agg(*_aggs())
    return g.select("server_id", F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), *OUT_COLS[3:])


def slice_stream(log_stream: DataFrame, watermark: str = DEFAULT_WATERMARK, width: str = SLICE_WIDTH) -> DataFrame:
    """Streaming slices. The watermark needs a TIMESTAMP column, so the UTC wall-clock
    ``log_ts`` is cast (session zone UTC) for event time and kept as-is for the output."""
    s = log_stream.withColumn("_event_time", F.col("log_ts").cast("timestamp")).withWatermark("_event_time", watermark)
    g = s.groupBy("server_id", F.window("_event_time", width).alias("w")).agg(*_aggs())
    return g.select("server_id", F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), *OUT_COLS[3:])


def run_slice_stream(spark: SparkSession, log_stream: DataFrame, sink_path: str, checkpoint_path: str,
                     watermark: str = DEFAULT_WATERMARK, available_now: bool = True,
                     processing_time: str | None = None) -> StreamingQuery:
    """Start the slice stream into a parquet sink (exactly-once file sink with its own
    checkpoint in the shared folder). ``available_now`` drains what is there and stops."""
    ensure_utc(spark)
    w = (slice_stream(log_stream, watermark).writeStream.format("parquet").outputMode("append")
         .option("path", sink_path).option("checkpointLocation", checkpoint_path))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "2 hours")
    return w.start()

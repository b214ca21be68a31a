"""W35 as a stream: event rows appended to the event log as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetwarden.operators.ledger import append_events
from fleetwarden.streaming.commits import begin, commit, write_output


def append_events_stream(events_in: DataFrame, sink_path: str, checkpoint_path: str, user: str,
                         id_col: str = "id", available_now: bool = True, now=None) -> StreamingQuery:
    """Each micro-batch fills a missing time with ``now`` or the batch's own timestamp and a missing
    user with ``user``, then appends to parquet. ``foreachBatch`` with the batch id makes
    the append idempotent on replay: a batch writes to its own ``batch=<id>`` folder."""

    def _write(batch: DataFrame, batch_id: int) -> None:
        rows = append_events(batch, F.current_timestamp().cast("timestamp_ntz") if now is None else now, user, id_col)
        rows.write.mode("overwrite").parquet(f"{sink_path}/batch={batch_id}")

    w = events_in.writeStream.foreachBatch(_write).option("checkpointLocation", checkpoint_path)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def append_events_once(events_in: DataFrame, out: str, checkpoint_path: str, user: str, id_col: str = "id",
                       within: str = "1 day", available_now: bool = True, now=None) -> StreamingQuery:
    """``append_events_stream`` for sources that may hand an event in again (a log file that
    was delivered twice, a collector that starts over): of the rows with one identifier the
    first goes in, as long as the others come ``within`` that time of it. Each micro-batch
    is written with a commit record (see ``commits``): readers take the rows of
    ``commits.committed(spark, out, "events", schema)`` and never see half a batch.
    Events without a time count as happening at ``now`` (the current time where not given)."""
    at = F.coalesce(F.col("event_date"), F.current_timestamp().cast("timestamp_ntz") if now is None else F.lit(now).cast("timestamp_ntz"))
    once = (events_in.withColumn("_event_time", at.cast("timestamp")).withWatermark("_event_time", within)
            .dropDuplicatesWithinWatermark([id_col]).drop("_event_time"))

    def _write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        begin(spark, out, batch_id)
        filled = append_events(batch, F.current_timestamp().cast("timestamp_ntz") if now is None else now, user, id_col)
        write_output(filled, out, "events", batch_id)
        commit(spark, out, batch_id)

    w = once.writeStream.foreachBatch(_write).option("checkpointLocation", checkpoint_path)
    return (w.trigger(availableNow=True) if available_now else w).start()

import os
import tempfile

from pyspark.sql import functions as F

from fleetwarden.plans import standins as S
from fleetwarden.streaming import run_slice_stream, slice_windows
from fleetwarden.streaming.eventlog import append_events_stream

from .conftest import SF_SMALL


def test_stream_equals_batch_on_closed_windows(spark):
    schema = spark.read.parquet(os.path.join(SF_SMALL, "events.parquet")).schema
    ev = (spark.readStream.format("parquet").schema(schema).option("pathGlobFilter", "events.parquet")
          .option("maxFilesPerTrigger", 1).load(SF_SMALL))
    lg = ev.select(F.col("user_id").cast("int").alias("server_id"), F.col("ts").alias("log_ts"),
                   F.concat(F.col("event_type"), F.lit(" "), F.col("props")).alias("line"))
    root = tempfile.mkdtemp(prefix="fw-stream-")
    q = run_slice_stream(spark, lg, os.path.join(root, "out"), os.path.join(root, "ckpt"))
    q.awaitTermination()
    streamed = spark.read.parquet(os.path.join(root, "out"))
    batch = slice_windows(S.logs(spark, SF_SMALL))
    max_ts = S.logs(spark, SF_SMALL).agg(F.max("log_ts")).first()[0]
    closed = batch.filter(F.col("window_end") <= F.lit(max_ts) - F.expr("INTERVAL 10 MINUTES"))
    cols = ["server_id", "window_start", "window_end", "line_count", "slice_bytes", "first_ts", "last_ts"]
    a = sorted(tuple(r) for r in streamed.select(*cols).collect())
    b = sorted(tuple(r) for r in closed.select(*cols).collect())
    assert a == b and len(a) > 0
    assert batch.count() - len(a) <= batch.filter(F.col("window_end") > F.lit(max_ts) - F.expr("INTERVAL 10 MINUTES")).count()


def test_event_log_stream(spark):
    src = tempfile.mkdtemp(prefix="fw-ev-src-")
    spark.createDataFrame([(1, None, None, "a"), (2, None, "bob", "b")],
                          "id long, event_date timestamp_ntz, user_id string, description string") \
        .write.mode("overwrite").parquet(os.path.join(src, "in"))
    schema = spark.read.parquet(os.path.join(src, "in")).schema
    stream = spark.readStream.schema(schema).parquet(os.path.join(src, "in"))
    q = append_events_stream(stream, os.path.join(src, "out"), os.path.join(src, "ckpt"), "hub")
    q.awaitTermination()
    rows = {r.id: r for r in spark.read.parquet(os.path.join(src, "out")).collect()}
    assert rows[1].user_id == "hub" and rows[2].user_id == "bob" and rows[1].event_date is not None


def test_jsonlog_files_through_the_slice_stream(spark):
    import datetime as dt
    import json

    from fleetwarden.sources import read_jsonlog_stream
    root = tempfile.mkdtemp(prefix="fw-jsonstream-")
    src = os.path.join(root, "logs")
    times = [dt.datetime(2024, 3, 1, 0, 30), dt.datetime(2024, 3, 1, 1, 59, 59), dt.datetime(2024, 3, 1, 2, 0),
             dt.datetime(2024, 3, 1, 5, 0)]
    for sid in (1, 2):
        os.makedirs(os.path.join(src, f"server_id={sid}"))
        with open(os.path.join(src, f"server_id={sid}", "postgresql-Fri.json"), "w") as f:
            for t in times:
                f.write(json.dumps({"timestamp": t.strftime("%Y-%m-%d %H:%M:%S.000 UTC"), "message": "m"}) + "\n")
    q = run_slice_stream(spark, read_jsonlog_stream(spark, src), os.path.join(root, "out"), os.path.join(root, "ck"))
    q.awaitTermination()
    got = sorted((r.server_id, r.window_start.hour, r.line_count) for r in spark.read.parquet(os.path.join(root, "out")).collect())
    # windows [00,02) and [02,04) are closed by the 05:00 line; [04,06) is still open
    assert got == [(1, 0, 2), (1, 2, 1), (2, 0, 2), (2, 2, 1)]


def test_events_delivered_twice_take_a_few_batches_however_many_files(spark, tmp_path):
    import os

    from fleetwarden.plans.registry import QUERIES
    from fleetwarden.session import scratch_folders
    spark.range(64).selectExpr("id AS event_id", "timestamp_ntz '2024-01-01 00:00:00' AS ts", "id AS user_id", "'click' AS event_type",
                               "1.0D AS value", "'{}' AS props").repartition(8).write.option("maxRecordsPerFile", 2).parquet(f"{tmp_path}/events.parquet")
    given = {k: spark.conf.get(k) for k in ("spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes")}
    for k in given:
        spark.conf.set(k, "2000")
    try:
        rows = QUERIES["event_log_once"](spark, str(tmp_path))
    finally:
        for k, v in given.items():
            spark.conf.set(k, v)
    assert sorted(r.id for r in rows.collect()) == list(range(64))
    folder = {os.path.basename(p).rsplit("-", 1)[0]: p for p in scratch_folders(spark)}
    assert len(os.listdir(folder["events-twice"].removeprefix("file:"))) > 40
    assert len([b for b in os.listdir(folder["event-log-once"].removeprefix("file:") + "/marks") if b.startswith("batch=")]) <= 6

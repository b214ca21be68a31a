"""The slice run as a stream: batches, late lines, replays, commit records; events once."""

import datetime as dt
import os
import tempfile

from fleetwarden.plans import standins as S
from fleetwarden.plans.registry import QUERIES
from fleetwarden.session import delete_path
from fleetwarden.streaming import SliceLedgerStream, append_events_once, committed
from fleetwarden.streaming.commits import marks

from .conftest import SF_SMALL

T = dt.datetime
LOGS = "server_id int, log_ts timestamp_ntz, line string"
LEDGER = ("server_id int, pk_id_pgini int, run_ts timestamp_ntz, fk_pk_id_conn int, ins_date long, log_mod long, log_timer_slicing long, "
          "log_size long, log_slice_size long, log_name string, log_slice_name string")


def hub(spark):
    return {"servers": spark.createDataFrame([(1, 5432, "db-1", 32), (2, 5432, "db-2", 32)], "pk_id_conn int, conn_port int, conn_host string, switch_serv int"),
            "ini": spark.createDataFrame([(1, 1, "/r", "/o", "/l/"), (2, 2, "/r", "/o", "/l/")],
                                         "pk_id_pgini int, fk_pk_id_conn int, path_pgbg string, path_out_dir string, path_out_log_file string"),
            "schedule": spark.createDataFrame([(s, T(2024, 3, 1, h, 1)) for s in (1, 2) for h in (2, 4, 6, 8)], "server_id int, run_ts timestamp_ntz"),
            "files": spark.createDataFrame([(s, "postgresql-Fri.log", 10, T(2024, 3, 1, 1)) for s in (1, 2)],
                                           "server_id int, name string, size long, modification timestamp_ntz")}


def sizes(spark, out):
    return sorted((r.server_id, r.run_ts.hour, r.log_slice_size) for r in committed(spark, out, "ledger", LEDGER).collect())


def test_batches_late_lines_and_replays(spark):
    root = tempfile.mkdtemp(prefix="fw-sstream-")
    given, out = hub(spark), f"{root}/out"
    stream = SliceLedgerStream(spark, lambda: given, out)
    lines = lambda *rows: spark.createDataFrame([(s, t, x) for s, t, x in rows], LOGS)
    b0 = lines((1, T(2024, 3, 1, 0, 30), "aa"), (2, T(2024, 3, 1, 1, 59), "b"), (1, T(2024, 3, 1, 2, 5), "c"))
    b1 = lines((1, T(2024, 3, 1, 1, 30), "in time"), (2, T(2024, 3, 1, 4, 30), "d"))
    b2 = lines((1, T(2024, 3, 1, 0, 40), "late"), (1, T(2024, 3, 1, 3, 59), "late too"), (2, T(2024, 3, 1, 5, 0), "e"), (1, None, "no time"))
    b3 = lines((2, T(2024, 3, 1, 9, 0), "f"))
    stream.write_batch(b0, 0)
    assert sizes(spark, out) == []                  # 02:05 less ten minutes closes nothing
    stream.write_batch(b1, 1)
    first = [(1, 2, 3 + 8), (1, 4, 2), (2, 2, 2), (2, 4, 0)]
    assert sizes(spark, out) == first
    for _ in range(2):                              # batch 2 is replayed
        stream.write_batch(b2, 2)
    assert sizes(spark, out) == first
    assert sorted((r.server_id, r.window_start.hour, r.late_lines) for r in stream.late_lines().collect()) == [(1, 0, 1), (1, 2, 1)]
    stream.write_batch(b3, 3)
    assert sizes(spark, out) == sorted(first + [(1, 6, 0), (1, 8, 0), (2, 6, 4), (2, 8, 0)])
    assert [r.watermark for r in marks(spark, out).orderBy("batch").collect()] == [T(2024, 3, 1, 1, 55), T(2024, 3, 1, 4, 20), T(2024, 3, 1, 4, 50), T(2024, 3, 1, 8, 50)]
    # a batch that was cut off has no record: its rows are not read, its replay puts them back
    delete_path(spark, f"{out}/marks/batch=3")
    assert sizes(spark, out) == first
    stream.write_batch(b3, 3)
    assert len(sizes(spark, out)) == 8


def test_empty_batches(spark):
    root = tempfile.mkdtemp(prefix="fw-sstream-")
    given = hub(spark)
    stream = SliceLedgerStream(spark, lambda: given, f"{root}/out")
    none = spark.createDataFrame([], LOGS)
    for k, rows in enumerate((none, spark.createDataFrame([(1, T(2024, 3, 1, 3), "x")], LOGS), none, none)):
        stream.write_batch(rows, k)
    assert sizes(spark, f"{root}/out") == [(1, 2, 0), (2, 2, 0)]
    assert marks(spark, f"{root}/out").count() == 4 and stream.late_lines().count() == 0


def test_stream_in_several_files_equals_the_batch_run(spark):
    root = tempfile.mkdtemp(prefix="fw-sstream-")
    days = [r[0] for r in S.logs(spark, SF_SMALL).selectExpr("date(log_ts) d").distinct().orderBy("d").collect()]
    for k in range(4):      # files in the order of time
        part = S.logs(spark, SF_SMALL).where(S.F.to_date("log_ts").isin(days[k * len(days) // 4: (k + 1) * len(days) // 4]))
        part.coalesce(1).write.parquet(f"{root}/in/part={k}")
    given = {"servers": S.servers(spark, SF_SMALL), "ini": S.pg_ini(spark, SF_SMALL), "schedule": S.slice_runs(spark, SF_SMALL),
             "files": S.log_files(spark, SF_SMALL), "call_outcomes": S.call_outcomes(spark, SF_SMALL)}
    logs = spark.readStream.schema(f"{LOGS}, part int").option("maxFilesPerTrigger", 1).parquet(f"{root}/in").drop("part")
    stream = SliceLedgerStream(spark, lambda: given, f"{root}/out", strip_domain=S.HOST_DOMAIN)
    stream.start(logs, f"{root}/ckpt").awaitTermination()
    want = QUERIES["slice_stream_ledger"](spark, SF_SMALL)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(committed(spark, f"{root}/out", "ledger", want.schema)) == rows(want)
    assert marks(spark, f"{root}/out").count() == 4 and stream.late_lines().count() == 0
    assert len(os.listdir(f"{root}/out/hours")) <= 2 + 1


def test_events_once_and_never_half(spark):
    root = tempfile.mkdtemp(prefix="fw-once-")
    schema = "id long, event_date timestamp_ntz, user_id string, description string"
    rows = [(1, T(2024, 1, 1), "a", "x"), (2, None, None, "y"), (3, T(2024, 1, 2), None, "z")]
    for part in (rows[:2], rows[1:], rows):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
    read = lambda: committed(spark, f"{root}/out", "events", schema)
    assert read().count() == 0
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    append_events_once(source, f"{root}/out", f"{root}/ckpt", "hub", now=T(2024, 1, 3)).awaitTermination()
    assert sorted((r.id, r.user_id) for r in read().collect()) == [(1, "a"), (2, "hub"), (3, "hub")]
    delete_path(spark, f"{root}/out/marks")         # a batch being written has no record
    assert read().count() == 0

"""Slices of the log file that a run names: runs after midnight, pruned folders, raw files."""

import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from fleetwarden import jobs
from fleetwarden.operators import slicing
from fleetwarden.plans import standins as S
from fleetwarden.sources import current_state
from fleetwarden.sources.logdir import named_files, read_jsonlog, read_stderr_log
from fleetwarden.sources.sinks import write_logs_by_day

from .conftest import SF_SMALL

T = dt.datetime
LINES = [(T(2024, 3, 1, 22, 30), "a"), (T(2024, 3, 1, 23, 30), "b"), (T(2024, 3, 2, 0, 10), "c"), (T(2024, 3, 2, 0, 59, 59), "d")]


def fleet(spark):
    servers = spark.createDataFrame([(1, 5432, "db-1", 32)], "pk_id_conn int, conn_port int, conn_host string, switch_serv int")
    ini = spark.createDataFrame([(1, 1, "/r", "/o", "/l/")], "pk_id_pgini int, fk_pk_id_conn int, path_pgbg string, path_out_dir string, path_out_log_file string")
    return servers, ini


def runs_of(spark, *times):
    return spark.createDataFrame([(1, t) for t in times], "server_id int, run_ts timestamp_ntz")


def test_runs_after_midnight_leave_out_yesterdays_file(spark):
    logs = spark.createDataFrame([(1, t, x) for t, x in LINES], "server_id int, log_ts timestamp_ntz, line string")
    runs = runs_of(spark, T(2024, 3, 2, 0, 3), T(2024, 3, 2, 0, 30), T(2024, 3, 2, 1, 2), T(2024, 3, 2, 1, 40))
    tasks = slicing.slice_tasks(*fleet(spark), runs)

    def lines(read):
        rep = slicing.slice_report(logs, tasks, slicing.time_bounds(tasks), read=read)
        return {r.run_ts.strftime("%H:%M"): r.line_count for r in rep.collect()}
    # 00:03 names yesterday's file; the later runs name today's, which holds nothing before midnight
    assert lines(slicing.NAMED_FILE) == {"00:03": 2, "00:30": 0, "01:02": 2, "01:40": 2}
    assert lines(slicing.ALL_LINES) == {"00:03": 2, "00:30": 2, "01:02": 3, "01:40": 3}


def test_folders_are_pruned_by_the_tasks(spark):
    path = tempfile.mkdtemp(prefix="fw-days-") + "/logs"
    long = S.logs(spark, SF_SMALL).withColumn("line", F.repeat("line", 400))      # larger than the tasks, as logs are
    write_logs_by_day(long, path)
    days = spark.read.parquet(path).select("log_day").distinct().count()
    two = S.slice_runs(spark, SF_SMALL).where("server_id BETWEEN 1 AND 6 AND hour(run_ts) >= 4")
    first, last = two.agg(F.min("run_ts"), F.max("run_ts")).first()
    runs = two.where(F.col("run_ts").isin(first, last))
    tasks = slicing.slice_tasks(S.servers(spark, SF_SMALL), S.pg_ini(spark, SF_SMALL), runs, mask=0)
    from fleetwarden.session import stored
    tasks = stored(tasks, "tasks")
    rows = slicing.slice_rows(spark.read.parquet(path), tasks, slicing.time_bounds(tasks), read=slicing.NAMED_FILE)
    want = sorted(tuple(r) for r in slicing.slice_rows(long, tasks, read=slicing.NAMED_FILE).collect())
    assert sorted(tuple(r) for r in rows.collect()) == want and want
    rows.write.format("noop").mode("overwrite").save()
    plan = spark._jvm.PythonSQLUtils.explainString(rows._jdf.queryExecution(), "formatted")
    assert "dynamicpruningexpression(log_day" in plan
    # the two runs are far apart: literal bounds alone would read the days between as well
    assert days > 10 and tasks.select("run_ts").distinct().count() == 2


def raw_logs(fmt):
    root = tempfile.mkdtemp(prefix="fw-raw-")
    os.makedirs(f"{root}/server_id=1")
    for name, day in (("postgresql-Fri", 1), ("postgresql-Sat", 2), ("postgresql-Sun", 3)):
        with open(f"{root}/server_id=1/{name}.{'json' if fmt == 'jsonlog' else 'log'}", "w") as f:
            for t, x in LINES + [(T(2024, 3, 3, 5), "e")]:
                if t.day == day and fmt == "jsonlog":
                    f.write(json.dumps({"timestamp": f"{t:%Y-%m-%d %H:%M:%S}.000 UTC", "message": x}) + "\n")
                elif t.day == day:
                    f.write(f"{t:%Y-%m-%d %H:%M:%S}.000 UTC [7] LOG: {x}\n\tmore of {x}\n")
    return root


def test_raw_files_by_name(spark):
    tasks = slicing.slice_tasks(*fleet(spark), runs_of(spark, T(2024, 3, 2, 0, 3), T(2024, 3, 2, 1, 2)))
    assert named_files(tasks) == ["postgresql-Fri.log", "postgresql-Sat.log"]
    for fmt, read, per_line in (("jsonlog", read_jsonlog, 1), ("stderr", read_stderr_log, 2)):
        root = raw_logs(fmt)
        logs = read(spark, root, named_files(tasks))
        assert {r.log_name for r in logs.collect()} == {"postgresql-Fri.log", "postgresql-Sat.log"}
        rep = {r.run_ts.hour: r.line_count for r in slicing.slice_report(logs, tasks, read=slicing.NAMED_FILE).collect()}
        assert rep == {0: 2 * per_line, 1: 2 * per_line}
        assert read(spark, root).count() == 5 * per_line


def test_job_reads_raw_logs_and_names_its_batch_by_the_schedule(spark):
    root, logs = tempfile.mkdtemp(prefix="fw-njob-"), raw_logs("stderr")
    servers, ini = fleet(spark)
    servers.write.parquet(f"{root}/hub/servers")
    ini.write.parquet(f"{root}/hub/pg_ini")
    spark.createDataFrame([], "pk_id_db int").write.parquet(f"{root}/hub/databases")
    runs_of(spark, T(2024, 3, 2, 0, 3), T(2024, 3, 2, 1, 2)).write.parquet(f"{root}/runs")
    files = spark.createDataFrame([(1, "postgresql-Sat.log", 9, T(2024, 3, 2, 0, 1))], "server_id int, name string, size long, modification timestamp_ntz")
    files.write.parquet(f"{root}/files")
    for _ in range(2):      # the second one is a retry
        jobs.main(["slice", "--hub", f"{root}/hub", "--logs", logs, "--log-format", "stderr", "--files", f"{root}/files",
                   "--runs", f"{root}/runs", "--out", f"{root}/out"])
    assert os.listdir(f"{root}/out/slices") == ["batch=2024-03-02T010200"]
    assert spark.read.parquet(f"{root}/out/slices").count() == 8
    ledger = {r.run_ts.hour: r for r in current_state(spark, f"{root}/out/slice_ledger", "slice_ledger").collect()}
    assert len(ledger) == 2 and ledger[1].log_name == "postgresql-Sat.log" and ledger[1].log_slice_size > 0
    assert jobs.schedule_time(T(2024, 1, 1)) == T(2024, 1, 1)


def test_stream_job_and_compacted_ledgers(spark):
    """Ledgers for compaction hold what the appended ones do; the stream job, over the same
    lines in jsonlog files, cuts the same sizes from all lines."""
    from fleetwarden.sources.compaction import compacted_state
    from fleetwarden.streaming import committed
    root, logs = tempfile.mkdtemp(prefix="fw-cjob-"), raw_logs("jsonlog")
    servers, ini = fleet(spark)
    for name, df in (("servers", servers), ("pg_ini", ini), ("databases", spark.createDataFrame([], "pk_id_db int"))):
        df.write.parquet(f"{root}/hub/{name}")
    runs_of(spark, T(2024, 3, 2, 0, 3), T(2024, 3, 2, 1, 2)).write.parquet(f"{root}/runs")
    files = spark.createDataFrame([(1, "postgresql-Sat.log", 9, T(2024, 3, 2, 0, 1))], "server_id int, name string, size long, modification timestamp_ntz")
    files.write.parquet(f"{root}/files")
    common = ["--hub", f"{root}/hub", "--logs", logs, "--files", f"{root}/files", "--runs", f"{root}/runs"]
    rows = lambda df: sorted((r.run_ts.hour, r.log_slice_size, r.log_name) for r in df.collect())
    for store in ("appended", "compacted"):
        jobs.main(["slice", *common, "--log-format", "jsonlog", "--read", "window", "--out", f"{root}/{store}", "--store", store])
    want = rows(current_state(spark, f"{root}/appended/slice_ledger", "slice_ledger"))
    assert rows(compacted_state(spark, f"{root}/compacted/slice_ledger", "slice_ledger")) == want and len(want) == 2
    jobs.main(["compact", "--path", f"{root}/compacted/slice_ledger", "--ledger", "slice_ledger"])
    state = compacted_state(spark, f"{root}/compacted/slice_ledger", "slice_ledger")
    assert rows(state) == want and all("/base/" in f for f in state.inputFiles())
    jobs.main(["slice-stream", *common, "--out", f"{root}/stream"])
    assert rows(committed(spark, f"{root}/stream", "ledger", state.schema)) == want

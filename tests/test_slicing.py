import datetime as dt

from pyspark.sql import functions as F

from fleetwarden.operators import slicing

from .conftest import SF_SMALL

T = dt.datetime


def windows(spark, times):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "i int, run_ts timestamp_ntz")
    return [r for r in slicing.slice_window(df).orderBy("i").collect()]


def test_window_edge_table(spark):
    day = T(2024, 3, 1)
    times = [day, day.replace(minute=5), day.replace(minute=5, microsecond=1), day.replace(minute=10),
             day.replace(minute=10, microsecond=1), day.replace(hour=1, minute=59, second=59), day.replace(hour=2),
             T(2024, 1, 1, 0, 7), T(2024, 5, 7, 13, 4)]
    r = windows(spark, times)
    y22, mid = T(2024, 2, 29, 22), T(2024, 3, 1)
    assert [(x.log_name, x.window_start, x.window_end, x.end_inclusive) for x in r[:4]] == [
        ("postgresql-Thu.log", y22, mid, False), ("postgresql-Thu.log", y22, mid, False),
        ("postgresql-Thu.log", y22, T(2024, 2, 29, 23, 59, 59), True),
        ("postgresql-Thu.log", y22, T(2024, 2, 29, 23, 59, 59), True)]
    assert (r[4].log_name, r[4].window_start, r[4].window_end, r[4].window_crosses_file) == (
        "postgresql-Fri.log", y22, mid, True)
    assert (r[5].window_start, r[5].window_end, r[5].window_crosses_file) == (T(2024, 2, 29, 23), T(2024, 3, 1, 1), True)
    assert (r[6].window_start, r[6].window_end, r[6].window_crosses_file) == (mid, T(2024, 3, 1, 2), False)
    assert (r[7].log_name, r[7].window_start, r[7].window_end) == (
        "postgresql-Sun.log", T(2023, 12, 31, 22), T(2023, 12, 31, 23, 59, 59))
    assert (r[8].log_name, r[8].window_start, r[8].window_end) == ("postgresql-Tue.log", T(2024, 5, 7, 11), T(2024, 5, 7, 13))


def fleet(spark):
    servers = spark.createDataFrame([(1, 5432, "db-1.example.test", 32), (2, 5433, "db-2.example.test", 0)],
                                    "pk_id_conn int, conn_port int, conn_host string, switch_serv int")
    ini = spark.createDataFrame([(1, 1, "/opt/r", "/out", "/log/"), (7, 1, "/opt/r", "/out2", "/log2/")],
                                "pk_id_pgini int, fk_pk_id_conn int, path_pgbg string, path_out_dir string, "
                                "path_out_log_file string")
    return servers, ini


def test_tasks_names_and_paths(spark):
    servers, ini = fleet(spark)
    t = slicing.slice_tasks(servers, ini, T(2024, 3, 1, 14, 2), strip_domain=".example.test").orderBy("pk_id_pgini").collect()
    assert len(t) == 2                                          # two config rows -> two tasks
    assert t[0].compl_name == "db-1--5432--2024-03-01--12-00.html"
    assert t[0].log_path == "/log/postgresql-Fri.log" and t[1].slice_path == "/out2/db-1--5432--2024-03-01--12-00.html"


def test_slice_rows_bounds(spark):
    servers, ini = fleet(spark)
    tasks = slicing.slice_tasks(servers, ini.filter("pk_id_pgini = 1"), T(2024, 3, 1, 14, 2))
    logs = spark.createDataFrame([(1, T(2024, 3, 1, 11, 59, 59), "a"), (1, T(2024, 3, 1, 12), "b"),
                                  (1, T(2024, 3, 1, 13, 59, 59, 999999), "c"), (1, T(2024, 3, 1, 14), "d"),
                                  (2, T(2024, 3, 1, 12, 30), "e")], "server_id int, log_ts timestamp_ntz, line string")
    assert sorted(r.line for r in slicing.slice_rows(logs, tasks).collect()) == ["b", "c"]
    rep = slicing.slice_report(logs, tasks).first()
    assert (rep.line_count, rep.slice_bytes) == (2, 4)
    late = slicing.slice_tasks(servers, ini.filter("pk_id_pgini = 1"), T(2024, 3, 2, 0, 7))
    logs2 = spark.createDataFrame([(1, T(2024, 3, 1, 23, 59, 59, 500000), "x"), (1, T(2024, 3, 2), "y"),
                                   (1, T(2024, 3, 1, 22), "z")], "server_id int, log_ts timestamp_ntz, line string")
    assert sorted(r.line for r in slicing.slice_rows(logs2, late).collect()) == ["x", "z"]


def test_consecutive_windows_partition_the_log(spark):
    servers, ini = fleet(spark)
    runs = spark.createDataFrame([(1, T(2024, 3, 1, h, 1)) for h in range(2, 24, 2)], "server_id int, run_ts timestamp_ntz")
    tasks = slicing.slice_tasks(servers, ini.filter("pk_id_pgini = 1"), runs)
    logs = spark.createDataFrame([(1, T(2024, 3, 1, h, m), f"{h}:{m}") for h in range(0, 22) for m in (0, 17, 59)],
                                 "server_id int, log_ts timestamp_ntz, line string")
    got = sorted(r.line for r in slicing.slice_rows(logs, tasks).collect())
    assert got == sorted(r.line for r in logs.collect())       # every line exactly once


def test_listing_and_envelope(spark):
    servers, ini = fleet(spark)
    runs = spark.createDataFrame([(1, T(2024, 3, d, 14, 2)) for d in (1, 2, 3, 4)], "server_id int, run_ts timestamp_ntz")
    tasks = slicing.slice_tasks(servers, ini.filter("pk_id_pgini = 1"), runs)
    files = spark.createDataFrame([
        (1, "postgresql-Fri.log", 100, T(2024, 3, 1, 13)),                          # day 1: one file, lines
        (1, "postgresql-Sat.log", 50, T(2024, 3, 2, 9)),                            # day 2: one file, no lines
        (1, "a.log", 1, T(2024, 3, 3, 1)), (1, "b.log", 1, T(2024, 3, 3, 2)),      # day 3: two files
        (1, "c.LOG", 1, T(2024, 3, 4, 1)), (1, "old.log", 1, T(2024, 3, 3, 23)),   # day 4: none usable
    ], "server_id int, name string, size long, modification timestamp_ntz")
    logs = spark.createDataFrame([(1, T(2024, 3, 1, 12, 30), "x")], "server_id int, log_ts timestamp_ntz, line string")
    listing = slicing.log_listing(files, tasks=tasks)
    res = {r.run_ts.day: r for r in slicing.slice_results(slicing.slice_report(logs, tasks), listing).collect()}
    assert (res[1].status_text, res[1].report, res[1].slice_file_size, res[1].full_log_size) == ("report_ready", 2, 2, 100)
    assert (res[2].status_text, res[2].slice_file_size) == ("report_file_missing", -1)
    assert (res[3].status, res[3].status_text, res[3].sqlstate) == ("error", "exception", "P0003")
    assert res[4].status is None and res[4].status_text is None
    routed = slicing.route(slicing.slice_results(slicing.slice_report(logs, tasks), listing))
    assert routed["errors"].count() == 1 and routed["updates"].count() == 1 and routed["unrouted"].count() == 2
    upd = routed["updates"].first()
    assert upd.log_mod == int(T(2024, 3, 1, 13, tzinfo=dt.timezone.utc).timestamp())
    led = {r.run_ts.day: r for r in slicing.fold_slices(slicing.open_slices(tasks), routed["updates"]).collect()}
    assert led[1].log_name == "postgresql-Fri.log" and led[1].log_slice_size == 2
    assert led[2].log_name == ";" and led[2].log_size == 0 and led[2].log_slice_name.endswith(".html")
    js = {r.run_ts.day: r.reply for r in slicing.envelope_json(slicing.slice_results(
        slicing.slice_report(logs, tasks), listing)).collect()}
    assert '"status":"error"' in js[3] and '"status_text":"report_ready"' in js[1] and js[4] is None


def test_logs_stay_unshuffled_and_bounds_reach_the_scan(spark):
    """Below the broadcast threshold only the bucket list moves, even where the logs are larger."""
    import tempfile

    from fleetwarden.plans import standins as S
    from fleetwarden.session import stored
    root = tempfile.mkdtemp(prefix="fw-logs-")
    S.logs(spark, SF_SMALL).withColumn("line", F.repeat("line", 40)).write.parquet(f"{root}/logs")
    logs = spark.read.parquet(f"{root}/logs")
    tasks = stored(slicing.slice_tasks(S.servers(spark, SF_SMALL), S.pg_ini(spark, SF_SMALL), S.slice_runs(spark, SF_SMALL)), "tasks")
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in keep:
            spark.conf.set(k, "200k")
        rows = slicing.slice_rows(logs, tasks, slicing.time_bounds(tasks))
        rows.write.format("noop").mode("overwrite").save()
        plan = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    scan = [x for x in plan.splitlines() if "FileScan" in x and "line#" in x]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and len(scan) == 1
    assert "GreaterThanOrEqual(log_ts" in scan[0] and "LessThan(log_ts" in scan[0]
    log_side = plan.splitlines()
    at = next(i for i, x in enumerate(log_side) if "FileScan" in x and "line#" in x)
    depth = len(log_side[at]) - len(log_side[at].lstrip(" :+-*"))
    for x in reversed(log_side[:at]):  # the chain of nodes above the log scan
        here = len(x) - len(x.lstrip(" :+-*"))
        if here < depth:
            depth = here
            assert "Exchange" not in x, x

import datetime as dt
import os
import tempfile
import time

from fleetwarden.sources import Snapshot, list_log_dir


def test_list_log_dir(spark):
    d = tempfile.mkdtemp(prefix="fw-logs-")
    for name, body in (("postgresql-Mon.log", "abc\n"), ("postgresql-Tue.log", "x" * 10), ("notes.csv", "1")):
        with open(os.path.join(d, name), "w") as f:
            f.write(body)
    rows = {r.name: r for r in list_log_dir(spark, d, server_id=3).collect()}
    assert rows["postgresql-Mon.log"].size == 4 and rows["notes.csv"].server_id == 3
    assert rows["postgresql-Tue.log"].modification.year == time.gmtime().tm_year
    only = list_log_dir(spark, d, glob="*.log").collect()
    assert sorted(r.name for r in only) == ["postgresql-Mon.log", "postgresql-Tue.log"]


def test_snapshot_roundtrip(spark):
    root = tempfile.mkdtemp(prefix="fw-snap-")
    s = Snapshot(pg_am=spark.createDataFrame([(1, 403, "btree"), (2, 403, "btree")], "db_id long, oid long, amname string"))
    s.write(root)
    back = Snapshot.read(spark, root)
    assert back.pg_am.count() == 2 and back.pg_class is None


def test_ledger_append_and_current_state(spark):
    import datetime as dt

    from fleetwarden.sources import append_ledger, current_state
    root = tempfile.mkdtemp(prefix="fw-ledger-")
    schema = "fk_pk_id_db_j int, det_date long, det_index_name string"
    append_ledger(spark.createDataFrame([(1, 100, "NIHIL"), (2, 100, "NIHIL")], schema), root, "run_ledger",
                  dt.datetime(2024, 1, 1, 1))
    append_ledger(spark.createDataFrame([(1, 100, "idx_a")], schema), root, "run_ledger", dt.datetime(2024, 1, 1, 2))
    got = {r.fk_pk_id_db_j: r.det_index_name for r in current_state(spark, root, "run_ledger").collect()}
    assert got == {1: "idx_a", 2: "NIHIL"}


def test_read_jsonlog_and_slice(spark):
    import datetime as dt
    import json

    from fleetwarden.operators import slicing
    from fleetwarden.sources import read_jsonlog
    root = tempfile.mkdtemp(prefix="fw-jsonlog-")
    recs = {1: ["2024-03-01 11:59:59.900 UTC", "2024-03-01 12:00:00.000 UTC", "2024-03-01 13:30:00.250 UTC"],
            2: ["2024-03-01 12:10:00.000 UTC"]}
    for sid, times in recs.items():
        os.makedirs(os.path.join(root, f"server_id={sid}"))
        with open(os.path.join(root, f"server_id={sid}", "postgresql-Fri.json"), "w") as f:
            for t in times:
                f.write(json.dumps({"timestamp": t, "error_severity": "LOG", "message": "x"}) + "\n")
    logs = read_jsonlog(spark, root)
    rows = sorted((r.server_id, r.log_ts) for r in logs.collect())
    assert rows[0] == (1, dt.datetime(2024, 3, 1, 11, 59, 59, 900000)) and len(rows) == 4
    tasks = spark.createDataFrame([(1, 1, dt.datetime(2024, 3, 1, 14, 2), dt.datetime(2024, 3, 1, 12),
                                    dt.datetime(2024, 3, 1, 14), False, "r.html", "postgresql-Fri.log")],
                                  "server_id int, pk_id_pgini int, run_ts timestamp_ntz, window_start timestamp_ntz, "
                                  "window_end timestamp_ntz, end_inclusive boolean, compl_name string, log_name string")
    rep = slicing.slice_report(logs, tasks).first()
    assert rep.line_count == 2
    assert rep.slice_bytes == sum(len(json.dumps({"timestamp": t, "error_severity": "LOG", "message": "x"})) + 1
                                  for t in recs[1][1:])


def test_write_slices_keeps_every_line(spark):
    from fleetwarden.operators import slicing
    from fleetwarden.plans import standins as S
    from fleetwarden.sources import write_slices

    from .conftest import SF_SMALL
    tasks = slicing.slice_tasks(S.servers(spark, SF_SMALL), S.pg_ini(spark, SF_SMALL), S.slice_runs(spark, SF_SMALL))
    rows = slicing.slice_rows(S.logs(spark, SF_SMALL), tasks)
    out = os.path.join(tempfile.mkdtemp(prefix="fw-slices-"), "s")
    write_slices(rows, out, "b1")
    back = spark.read.parquet(out)
    assert back.count() == rows.count() > 0
    assert sorted(r.window_day.isoformat() for r in back.select("window_day").distinct().collect())[0].startswith("202")


def test_read_stderr_log_continuations(spark):
    import datetime as dt

    from fleetwarden.sources import read_stderr_log
    root = tempfile.mkdtemp(prefix="fw-stderr-")
    lines = ["2024-03-01 11:59:59.100 UTC [7] LOG:  statement: SELECT 1",
             "\tFROM t",
             "2024-03-01 12:00:00 UTC [7] LOG:  statement: SELECT",
             "\t2",
             "\t3",
             "2024-03-01 12:30:00.5 UTC [8] ERROR:  boom"]
    os.makedirs(os.path.join(root, "server_id=4"))
    with open(os.path.join(root, "server_id=4", "postgresql-Fri.log"), "w") as f:
        f.write("\n".join(lines) + "\n")
    got = sorted((r.log_ts, r.line) for r in read_stderr_log(spark, root).collect())
    t1, t2, t3 = dt.datetime(2024, 3, 1, 11, 59, 59, 100000), dt.datetime(2024, 3, 1, 12), dt.datetime(2024, 3, 1, 12, 30, 0, 500000)
    assert got == sorted([(t1, lines[0]), (t1, lines[1]), (t2, lines[2]), (t2, lines[3]), (t2, lines[4]), (t3, lines[5])])


def test_read_stderr_log_across_splits(spark):
    """Force many small splits so continuation lines start splits and batches."""
    import datetime as dt

    from fleetwarden.sources import read_stderr_log
    root = tempfile.mkdtemp(prefix="fw-stderr2-")
    os.makedirs(os.path.join(root, "server_id=1"))
    expect = []
    with open(os.path.join(root, "server_id=1", "postgresql-Sat.log"), "w") as f:
        for i in range(3000):
            t = dt.datetime(2024, 3, 2) + dt.timedelta(seconds=i)
            head = f"{t:%Y-%m-%d %H:%M:%S} UTC [1] LOG:  record {i}"
            f.write(head + "\n")
            expect.append((t, head))
            for k in range(i % 4):
                cont = f"\tcontinued {i}.{k} " + "x" * 40
                f.write(cont + "\n")
                expect.append((t, cont))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    old_batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for split_bytes, batch_rows in (("4096", "10000"), ("4096", "3"), ("65536", "2")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch_rows)
            got = sorted((r.log_ts, r.line) for r in read_stderr_log(spark, root).collect())
            assert got == sorted(expect), (split_bytes, batch_rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old_batch)


def _zoned_rows(spark, reader, lines):
    import tempfile
    root = tempfile.mkdtemp(prefix="fw-zone-")
    os.makedirs(f"{root}/server_id=1")
    with open(f"{root}/server_id=1/a.log", "w") as f:
        f.write("\n".join(lines) + "\n")
    return {r.line: r.log_ts for r in reader(spark, root).collect()}


ZONES = [("2024-03-01 12:00:00.123 UTC", (12, 123000)), ("2024-03-01 12:00:00 UTC", (12, 0)), ("2024-03-01 12:00:00.5 +03", (9, 500000)),
         ("2024-03-01 12:00:00.123456 -0330", (15, 123456)), ("2024-03-01 12:00:00 Europe/Berlin", (11, 0)), ("2024-03-01 12:00:00", (12, 0))]


def test_log_times_keep_their_zone(spark):
    from fleetwarden.sources import read_jsonlog, read_stderr_log
    want = {t: dt.datetime(2024, 3, 1, h, 30 if "0330" in t else 0, 0, us) for t, (h, us) in ZONES}
    got = _zoned_rows(spark, read_jsonlog, [f'{{"timestamp":"{t}","pid":1}}' for t, _ in ZONES])
    assert {k.split('"')[3]: v for k, v in got.items()} == want
    got = _zoned_rows(spark, read_stderr_log, [f"{t} [1] LOG:  x" for t, _ in ZONES])
    assert {k.split(" [")[0]: v for k, v in got.items()} == want


def test_unreadable_times_are_counted_and_leading_lines_kept(spark):
    from fleetwarden.sources import read_jsonlog, read_stderr_log
    from fleetwarden.sources.logdir import untimed_lines
    got = _zoned_rows(spark, read_jsonlog, ['{"timestamp":"noon","pid":1}', "not json", '{"timestamp":"2024-03-01 12:00:00 Nowhere/Land"}',
                                            '{"timestamp":"2024-03-01 12:00:00 UTC"}'])
    assert sum(v is None for v in got.values()) == 3
    df = spark.createDataFrame([(1, v) for v in got.values()], "server_id int, log_ts timestamp_ntz")
    assert [(r.untimed, r.lines) for r in untimed_lines(df).collect()] == [(3, 4)]
    got = _zoned_rows(spark, read_stderr_log, ["tail of an older record", "2024-03-01 12:00:00 UTC [1] LOG:  x", "\tmore"])
    assert set(got.values()) == {dt.datetime(2024, 3, 1, 12)}


def test_damaged_catalog_raises(spark):
    import tempfile

    import pytest
    root = tempfile.mkdtemp(prefix="fw-cat-")
    spark.range(3).selectExpr("id AS db_id").write.parquet(f"{root}/pg_am")
    assert Snapshot.read(spark, root).settings is None
    os.makedirs(f"{root}/settings")
    with open(f"{root}/settings/part-0.parquet", "w") as f:
        f.write("broken")
    with pytest.raises(Exception):
        Snapshot.read(spark, root).settings.collect()


def test_hot_database_is_split_on_write(spark):
    import tempfile
    root = tempfile.mkdtemp(prefix="fw-hot-")
    df = spark.range(60_000).selectExpr("if(id % 3 = 0, 7, id) AS db_id", "uuid() AS amname")
    Snapshot(pg_am=df).write(root, max_records_per_file=5_000)
    back = spark.read.parquet(f"{root}/pg_am")
    assert back.count() == 60_000 and len(back.inputFiles()) >= 12


def test_fleet_listing_in_one_scan(spark):
    import tempfile

    from fleetwarden.sources import list_log_dir
    root = tempfile.mkdtemp(prefix="fw-list-")
    for n in (1, 2):
        os.makedirs(f"{root}/server_id={n}")
        with open(f"{root}/server_id={n}/postgresql-{n}.log", "w") as f:
            f.write("x" * n)
    assert sorted((r.server_id, r.name, r["size"]) for r in list_log_dir(spark, root).collect()) == [
        (1, "postgresql-1.log", 1), (2, "postgresql-2.log", 2)]


def test_equal_batches_fold_to_one_row(spark):
    import tempfile

    from fleetwarden.sources import append_ledger, current_state
    root = tempfile.mkdtemp(prefix="fw-tie-")
    rows = spark.createDataFrame([(1, 2, "a"), (1, 2, "b"), (3, 2, "c")], "fk_pk_id_db_j int, det_date long, det_index_name string")
    append_ledger(rows, root, "run_ledger", "2024-01-01 00:00:00")
    append_ledger(rows, root, "run_ledger", "2024-01-01 00:00:00")
    got = sorted((r.fk_pk_id_db_j, r.det_index_name) for r in current_state(spark, root, "run_ledger").collect())
    assert got == [(1, "b"), (3, "c")]

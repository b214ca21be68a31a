"""The log listing as a data source, batch and stream; replies of any shape."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from fleetwarden.operators import slicing
from fleetwarden.sources.logdir import list_log_dir
from fleetwarden.sources.loglisting import LogListing


def put(root, server, name, text, at):
    os.makedirs(f"{root}/server_id={server}", exist_ok=True)
    path = f"{root}/server_id={server}/{name}"
    with open(path, "w") as f:
        f.write(text)
    os.utime(path, (at, at))


def listed(df):
    return sorted(tuple(r) for r in df.select("server_id", "name", "size", "modification").collect())


def test_source_equals_the_listing_of_files(spark):
    root = tempfile.mkdtemp(prefix="fw-list-")
    for server in range(1, 70):
        put(root, server, "postgresql-Fri.log", "x" * server, 1_700_000_000 + server)
    put(root, 3, "postgresql-Sat.log", "s", 1_700_000_500)
    os.makedirs(f"{root}/server_id=99")
    os.makedirs(f"{root}/other")
    spark.dataSource.register(LogListing)
    got = spark.read.format("log_listing").load(root)
    assert listed(got) == listed(list_log_dir(spark, root)) and got.count() == 70 and got.rdd.getNumPartitions() == 2
    put(root, 5, "postgresql-Sat.log", "", 1_700_000_600)          # an empty log is a log, too
    assert got.where("size = 0").count() == 1
    assert spark.read.format("log_listing").load(tempfile.mkdtemp(prefix="fw-list-")).count() == 0


def test_stream_reports_new_and_grown_files_once(spark):
    root = tempfile.mkdtemp(prefix="fw-list-")
    logs, out = f"{root}/logs", f"{root}/out"
    spark.dataSource.register(LogListing)

    def drain():
        stream = spark.readStream.format("log_listing").option("settle", 0).load(logs)
        (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{root}/ckpt")
         .trigger(availableNow=True).start().awaitTermination())
        return sorted((r.server_id, r.name, r.size) for r in spark.read.parquet(out).collect())
    put(logs, 1, "a.log", "aa", 1_700_000_000)
    put(logs, 2, "b.log", "b", 1_700_000_001)
    first = [(1, "a.log", 2), (2, "b.log", 1)]
    assert drain() == first and drain() == first
    put(logs, 3, "c.log", "ccc", 1_700_000_010)
    put(logs, 1, "a.log", "aaaa", 1_700_000_011)        # has grown
    assert drain() == sorted(first + [(3, "c.log", 3), (1, "a.log", 4)])


def test_replies_of_any_shape(spark):
    replies = ['{"status":"error","status_text":"exception","message":"m","sqlstate":55000}',
               '{"status_text":"report_ready","full_log_size":"12","slice_file_size":7,"full_log_modf":"2024-01-15T12:00:00.5+00:00","full_log_name":"a.log"}',
               '{"status_text":"init","more":{"a":[1]},"status_text":"report_ready","full_log_size":3000000000,"slice_file_size":1.5,"full_log_name":{"x":1}}',
               '{"full_log_size":"many","full_log_modf":"soon","status":null}', "no json", None, "[1]", '"text"']
    df = spark.createDataFrame([(k, k, dt.datetime(2024, 1, 1), r, 0) for k, r in enumerate(replies)],
                               "server_id int, pk_id_pgini int, run_ts timestamp_ntz, reply string, timer_seconds long")
    got = {r.server_id: r for r in slicing.read_variant_replies(df).collect()}
    assert (got[0].status, got[0].sqlstate, got[0].full_log_size) == ("error", "55000", None)
    assert (got[1].full_log_size, got[1].slice_file_size, got[1].full_log_modf) == (12, 7, dt.datetime(2024, 1, 15, 12, 0, 0, 500000))
    assert (got[2].status_text, got[2].full_log_size, got[2].full_log_name) == ("report_ready", 3_000_000_000, '{"x":1}')
    assert all(v is None for v in (got[3].full_log_size, got[3].full_log_modf, got[3].status))
    assert all(got[k].status is None and got[k].status_text is None for k in (4, 5, 6, 7))
    labels = {r.server_id: r.route for r in slicing.route_label(slicing.read_variant_replies(df)).collect()}
    assert labels == {0: "error", 1: "update", 2: "update", **dict.fromkeys(range(3, 8), "none")}
    plain = df.where("server_id < 2").withColumn("reply", F.replace("reply", F.lit('"12"'), F.lit("12")))
    a, b = (sorted(map(str, f(plain).select("status", "status_text", "full_log_size", "full_log_modf", "full_log_name").collect()))
            for f in (slicing.read_replies, slicing.read_variant_replies))
    assert a == b


def test_log_folders_hold_one_whole_file_a_server(spark, tmp_path):
    from fleetwarden.sources.loglisting import write_log_folders
    lines = spark.createDataFrame([(1, "a"), (2, "ü"), (1, None), (2, ""), (1, "b")], "server_id int, line string").repartition(3)
    for _ in range(2):  # a task that runs again replaces its files
        write_log_folders(lines, f"file://{tmp_path}/logs")
    found = {str(p.relative_to(tmp_path / "logs")): sorted(p.read_bytes().split(b"\n")[:-1]) for p in (tmp_path / "logs").rglob("*") if p.is_file()}
    assert found == {"server_id=1/postgresql.txt": [b"", b"a", b"b"], "server_id=2/postgresql.txt": [b"", "ü".encode()]}
    write_log_folders(lines.limit(0), f"file://{tmp_path}/none")
    spark.dataSource.register(LogListing)
    assert spark.read.format("log_listing").load(f"file://{tmp_path}/none").count() == 0

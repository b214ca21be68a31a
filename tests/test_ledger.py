import datetime as dt

from pyspark.sql import functions as F

from fleetwarden.operators import ledger

RUN = dt.datetime(2024, 1, 15, 1, 0)
OUT_SCHEMA = ("server_id int, db_id int, ok boolean, schema_name string, table_name string, index_name string, "
              "bloat_before double, bloat_after double, seconds long, err_message string, err_detail string, "
              "err_code string")


def targets(spark, pairs):
    return spark.createDataFrame(pairs, "server_id int, db_id int")


def outcomes(spark, rows):
    return spark.createDataFrame(rows, OUT_SCHEMA)


def ok(s, d, name, before, after=10.0, secs=3):
    return (s, d, True, "public", "t", name, before, after, secs, None, None, None)


def bad(s, d, name, before):
    return (s, d, False, "public", "t", name, before, None, None, "failed", None, "55000")


def test_open_defaults(spark):
    r = ledger.open_runs(targets(spark, [(1, 10)]), RUN).first()
    assert r.det_date == int(RUN.replace(tzinfo=dt.timezone.utc).timestamp()) + 10800
    assert (r.det_clocking, r.det_perc_bloat, r.det_perc_bloat_after) == (11232000, 0.0, -999.0)
    assert r.det_index_name == "NIHIL" and r.run_key == f"10@{r.det_date}"


def test_fold_zero_one_many(spark):
    runs = ledger.open_runs(targets(spark, [(1, 10), (1, 11), (1, 12)]), RUN)
    o = outcomes(spark, [ok(1, 11, "a", 30.0), ok(1, 12, "b", 40.0, -333.0, 7), ok(1, 12, "c", 90.0, 5.0, 9),
                         ok(1, 12, "d", 50.0)])
    f = {r.fk_pk_id_db_j: r for r in ledger.fold_runs(runs, o).collect()}
    assert f[10].det_index_name == "NIHIL" and f[10].det_perc_bloat_after == -999.0
    assert f[11].det_index_name == "a" and f[11].det_perc_bloat == 30.0
    assert (f[12].det_index_name, f[12].det_clocking, f[12].det_perc_bloat_after) == ("c", 9, 5.0)   # largest last
    assert ledger.run_errors(runs, o).count() == 0


def test_stop_run_at_second_database(spark):
    runs = ledger.open_runs(targets(spark, [(1, 10), (1, 11), (2, 12)]), RUN)
    o = outcomes(spark, [ok(1, 10, "a", 30.0), ok(1, 11, "b", 30.0), bad(1, 11, "c", 40.0), ok(1, 11, "d", 50.0),
                         ok(2, 12, "e", 60.0)])
    f = {r.fk_pk_id_db_j: r for r in ledger.fold_runs(runs, o).collect()}
    assert sorted(f) == [10, 11]                        # the run stopped: database 12 never opened
    assert f[11].det_index_name == "b"                  # the row keeps the index before the failure
    e = ledger.run_errors(runs, o).collect()
    assert len(e) == 1 and e[0].err_label == "DBLINK_CONNECT_REINDEX" and e[0].err_detail == "*"
    skip = {r.fk_pk_id_db_j: r for r in ledger.fold_runs(runs, o, "skip_database").collect()}
    assert sorted(skip) == [10, 11, 12] and skip[12].det_index_name == "e"


def test_connect_failure(spark):
    runs = ledger.open_runs(targets(spark, [(1, 10), (1, 11)]), RUN)
    o = outcomes(spark, [(1, 10, False, None, None, None, None, None, None, "no route", None, "08001"),
                         ok(1, 10, "a", 30.0), ok(1, 11, "b", 30.0)])
    f = {r.fk_pk_id_db_j: r for r in ledger.fold_runs(runs, o).collect()}
    assert list(f) == [10] and f[10].det_index_name == "NIHIL"
    assert ledger.run_errors(runs, o).first().err_label == "DBLINK_CONNECT"


def test_error_rows_defaults_and_events(spark):
    df = spark.createDataFrame([(1, None, "m", None, None, None)],
                               "fk_pk_id_conn int, slice_now_ins timestamp_ntz, slice_err_mess string, "
                               "slice_err_detail string, slice_err_code string, work_scheme string")
    r = ledger.error_rows(df, "slicer", now=RUN).first()
    assert (r.slice_now_ins, r.slice_err_mess, r.slice_err_detail, r.work_scheme) == (RUN, "m", ";", ";")
    ev = spark.createDataFrame([(1, None, None, "d"), (2, RUN, "bob", "e")],
                               "id long, event_date timestamp_ntz, user_id string, description string")
    got = {r.id: r for r in ledger.append_events(ev, dt.datetime(2024, 2, 1), "hub").collect()}
    assert got[1].event_date == dt.datetime(2024, 2, 1) and got[1].user_id == "hub" and got[2].user_id == "bob"
    assert F is not None


def test_fold_has_one_row_per_run(spark):
    runs = ledger.open_runs(targets(spark, [(1, d) for d in range(10, 20)]), RUN)
    o = outcomes(spark, [ok(1, d, f"i{d}_{k}", float(k * 7 % 50)) for d in range(10, 20) for k in range(5)])
    f = ledger.fold_runs(runs, o)
    assert f.count() == 10 and f.select("run_key").distinct().count() == 10

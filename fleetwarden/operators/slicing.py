"""Two-hourly log slicing (W21-W28): windows, file names, tasks, the slice itself,
the result envelope, its routing and the slice ledger.

Times are TIMESTAMP_NTZ on the UTC wall clock.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwarden.functions.flags import BIT_LOG_REPORTS
from fleetwarden.functions.slicewin import effective_end, window_columns
from fleetwarden.functions.timeexpr import as_ntz, epoch_seconds
from fleetwarden.operators.fleet import KEEP_NULLS, with_flag

TASK_KEY = ["server_id", "pk_id_pgini", "run_ts"]
WINDOW_KEY = ["server_id", "window_start", "window_end", "end_inclusive"]

#: What a slice is cut from: the log file that its run names, or all lines of the server.
NAMED_FILE, ALL_LINES = "named", "window"

# The remote slicer's status ladder and its error text.
STATUS_READY = "report_ready"
STATUS_MISSING = "report_file_missing"
STATUS_ERROR = "error"
STATUS_EXCEPTION = "exception"
REPORT_READY, REPORT_MISSING = 2, -1
TOO_MANY_ROWS_MESSAGE = "query returned more than one row"
TOO_MANY_ROWS_SQLSTATE = "P0003"
LOG_SUFFIX = ".log"
# Slice-ledger defaults.
LEDGER_LOG_NAME_DEFAULT = ";"


def slice_window(df: DataFrame, run_ts: str = "run_ts") -> DataFrame:
    """W21 + W22: window start / end, whether the end's last second counts, the log day and
    ``postgresql-<Dy>.log`` name, and whether the window starts on another day than the log."""
    return df.withColumns(window_columns(F.col(run_ts)))


def log_name(df: DataFrame, run_ts: str = "run_ts") -> DataFrame:
    """W22 alone: the day-of-week log file a run reads."""
    w = window_columns(F.col(run_ts))
    return df.withColumns({"log_day": w["log_day"], "log_name": w["log_name"]})


def slice_tasks(servers: DataFrame, ini: DataFrame, runs, mask: int = BIT_LOG_REPORTS,
                strip_domain: str | None = None) -> DataFrame:
    """One task per (flagged server, slicer config row, run).

    ``runs`` is either a DataFrame ``(server_id, run_ts)`` (a schedule) or one run time.
    The report name is ``host--port`` without ``strip_domain``, then ``--``, the window
    start as ``yyyy-MM-dd--HH-mm`` and ``.html``; the log path is the log folder followed
    directly by the log name; the slice path is ``out_dir/report``.
    """
    s = with_flag(servers, "switch_serv", mask).select(
        F.col("pk_id_conn").alias("server_id"), F.col("conn_port").alias("serv_port"),
        F.col("conn_host").alias("serv_host"))
    i = ini.select("pk_id_pgini", F.col("fk_pk_id_conn").alias("server_id"), F.col("path_pgbg").alias("pgbg_path"),
                   F.col("path_out_dir").alias("out_dir"), F.col("path_out_log_file").alias("out_file"))
    t = s.join(i, "server_id")
    if isinstance(runs, DataFrame):
        t = t.join(runs.select("server_id", as_ntz(F.col("run_ts")).alias("run_ts")), "server_id")
    else:
        t = t.withColumn("run_ts", as_ntz(runs))
    t = slice_window(t)
    base = F.concat(F.col("serv_host"), F.lit("--"), F.col("serv_port").cast("string"))
    if strip_domain:
        base = F.replace(base, F.lit(strip_domain), F.lit(""))
    compl = F.concat(base, F.lit("--"), F.date_format(F.date_trunc("hour", "window_start"), "yyyy-MM-dd--HH-mm"),
                     F.lit(".html"))
    return t.select(
        "server_id", "pk_id_pgini", "run_ts", "serv_port", "serv_host", compl.alias("compl_name"),
        "out_dir", "out_file", "pgbg_path", "log_name", "window_start", "window_end", "end_inclusive",
        "window_crosses_file",
        F.concat(F.col("out_file"), F.col("log_name")).alias("log_path"),
        F.concat(F.col("out_dir"), F.lit("/"), compl).alias("slice_path"),
    )


def with_log_day(tasks: DataFrame) -> DataFrame:
    """Tasks with the day whose log their run names (a run soon after midnight names yesterday's)."""
    return tasks.withColumn("log_day", window_columns(F.col("run_ts"))["log_day"])


def slice_key(read: str) -> list[str]:
    """What tells slices apart: two runs can share a window and name different files."""
    return [*WINDOW_KEY, "log_day"] if read == NAMED_FILE else WINDOW_KEY


def _window_buckets(tasks: DataFrame, key: list[str] = WINDOW_KEY) -> DataFrame:
    """Distinct task windows, each exploded to the hours it touches (the equi-join key)."""
    w = tasks.select(*key).distinct()
    end = effective_end(F.col("window_end"), F.col("end_inclusive"))
    return w.withColumn("_end", end).withColumn(
        "_bucket", F.explode(F.sequence(F.date_trunc("hour", "window_start").cast("timestamp_ntz"),
                                        F.date_trunc("hour", F.col("_end") - F.expr("INTERVAL 1 MICROSECOND"))
                                        .cast("timestamp_ntz"),
                                        F.expr("INTERVAL 1 HOUR"))))


def time_bounds(tasks: DataFrame) -> tuple | None:
    """First window start and last (exclusive) window end of all tasks: one row."""
    row = tasks.agg(F.min("window_start").alias("a"), F.max(effective_end(F.col("window_end"), F.col("end_inclusive"))).alias("b")).first()
    return None if row["a"] is None else (row["a"], row["b"])


def within(logs: DataFrame, bounds: tuple | None) -> DataFrame:
    """The logs between two literal times, which reach the scan as pushed filters; logs
    stored by day (a ``log_day`` folder column) are pruned to the days between."""
    if bounds is None:
        return logs
    a, b = (F.lit(x).cast("timestamp_ntz") for x in bounds)
    logs = logs.filter((F.col("log_ts") >= a) & (F.col("log_ts") < b))
    return logs.filter(F.col("log_day").between(F.lit(bounds[0].date()), F.lit(bounds[1].date()))) if "log_day" in logs.columns else logs


def named_lines(logs: DataFrame) -> DataFrame:
    """Log lines with the day of the file they are in: the ``log_day`` folder they were read
    from or, in logs without it, their own day, as a server starts a file each day. Raw logs
    carry ``log_name`` instead, the name of their file."""
    return logs if "log_day" in logs.columns or "log_name" in logs.columns else logs.withColumn("log_day", F.to_date("log_ts"))


def slice_rows(logs: DataFrame, tasks: DataFrame, bounds: tuple | None = None, read: str = ALL_LINES) -> DataFrame:
    """Log lines with ``start <= log_ts < end`` (end inclusive of its last second for the
    23:59:59 window), per server.

    Each distinct window is exploded to hour buckets; logs join on ``(server_id, hour)`` and
    a residual range filter. ``tasks`` should be a stored table (``runs.slice_run`` stores
    it): its true size lets Spark broadcast the bucket list (servers x runs x 2-3 hours) and
    leave the logs where they are. Beyond the broadcast threshold both sides shuffle on
    ``(server_id, hour)``, which spreads even a server with a third of all lines over its
    hours. ``bounds`` (see ``time_bounds``) prunes the log scan. Windows off the two-hour
    grid (odd-hour runs) are handled the same way.

    ``read="named"`` cuts each slice from the one file that its run names, as the hub does: a
    run between 00:10 and 02:00 names today's file and so leaves out yesterday's lines of its
    window. The join then has the file in its key: the ``log_day`` folder of logs stored by
    day, whose folders are pruned at run time to those the tasks name, or ``log_name`` of raw
    logs. Rows carry ``log_day``.
    """
    bucket = F.date_trunc("hour", "log_ts").cast("timestamp_ntz").alias("_bucket")
    if read == NAMED_FILE:
        lg, tasks = named_lines(within(logs, bounds)), with_log_day(tasks)
        if bounds is not None:      # a filter on the tasks' side, which lets Spark prune folders by it
            tasks = tasks.filter(F.col("window_start") >= F.lit(bounds[0]).cast("timestamp_ntz"))
        file = "log_day" if "log_day" in lg.columns else "log_name"
        b = _window_buckets(tasks, [*slice_key(read), "log_name"])
        j = lg.select("server_id", "log_ts", "line", file, bucket).join(b, ["server_id", file, "_bucket"])
    else:
        j = within(logs, bounds).select("server_id", "log_ts", "line", bucket).join(_window_buckets(tasks), ["server_id", "_bucket"])
    j = j.filter((F.col("log_ts") >= F.col("window_start")) & (F.col("log_ts") < F.col("_end")))
    return j.select(*slice_key(read), "log_ts", "line")


def slice_report(logs: DataFrame | None, tasks: DataFrame, bounds: tuple | None = None, slices: DataFrame | None = None,
                 read: str = ALL_LINES) -> DataFrame:
    """Per task, the slice's line count, bytes (line + newline), first and last time.
    Aggregated per distinct window (partial aggregation before the shuffle), then joined
    back to the tasks; a window without lines reports 0 lines. ``slices``: slice rows that
    were written already, instead of the logs. ``read``: see ``slice_rows``."""
    rows = slice_rows(logs, tasks, bounds, read) if slices is None else slices
    agg = rows.groupBy(*slice_key(read)).agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum(F.octet_length("line") + 1).cast("long").alias("slice_bytes"),
        F.min("log_ts").alias("first_ts"), F.max("log_ts").alias("last_ts"))
    t = with_log_day(tasks) if read == NAMED_FILE else tasks
    t = t.select(*TASK_KEY, *slice_key(read)[1:], "compl_name", "log_name")
    return t.join(agg, slice_key(read), "left").select(
        *TASK_KEY, "window_start", "window_end", "end_inclusive", "compl_name", "log_name",
        F.coalesce("line_count", F.lit(0)).cast("long").alias("line_count"),
        F.coalesce("slice_bytes", F.lit(0)).cast("long").alias("slice_bytes"), "first_ts", "last_ts")


def report_of_hours(hours: DataFrame, tasks: DataFrame) -> DataFrame:
    """``slice_report`` from line counts, bytes and times by ``server_id, hour``: all windows
    start and end on the hour, the 23:59:59 one after its last second."""
    agg = (hours.withColumnRenamed("hour", "_bucket").join(_window_buckets(tasks), ["server_id", "_bucket"]).groupBy(*WINDOW_KEY)
           .agg(F.sum("line_count").alias("line_count"), F.sum("slice_bytes").alias("slice_bytes"),
                F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts")))
    t = tasks.select(*TASK_KEY, *WINDOW_KEY[1:], "compl_name", "log_name").join(agg, WINDOW_KEY, "left")
    return t.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("line_count", "slice_bytes")})


def log_listing(files: DataFrame, as_of=None, tasks: DataFrame | None = None) -> DataFrame:
    """``.log`` files (case-sensitive suffix) modified on the run's day.

    With ``tasks``, each run lists its own server's files for ``date(run_ts)`` (an equi-join
    on ``(server_id, day)``); otherwise ``as_of`` is one date for every server.
    """
    f = files.filter(F.col("name").endswith(LOG_SUFFIX)).select(
        "server_id", "name", "size", "modification", F.to_date("modification").alias("_day"))
    if tasks is not None:
        r = tasks.select("server_id", "run_ts", F.to_date("run_ts").alias("_day")).distinct()
        return f.join(r, ["server_id", "_day"]).select("server_id", "run_ts", "name", "size", "modification")
    return f.filter(F.col("_day") == F.to_date(F.lit(as_of))).select("server_id", "name", "size", "modification")


# The stages of a remote call that can fail, in their order.
DISCONNECT, CONNECT, CALL, UPDATE = "disconnect", "connect", "call", "update"


def reached_tasks(tasks: DataFrame, call_outcomes: DataFrame | None) -> DataFrame:
    """The tasks that their run reaches, with the outcome of their call.

    ``call_outcomes``: ``server_id, pk_id_pgini, run_ts, stage, err_message, err_detail,
    err_code, seconds``; ``stage`` is NULL for a call that succeeded, else the one that
    failed. A run processes its tasks by server, then config row. A failed connect ends the
    run, after its own task; the other failures concern their task alone.
    """
    if call_outcomes is None:
        return tasks.withColumns({"stage": F.lit(None).cast("string"), "err_message": F.lit(None).cast("string"),
                                  "err_detail": F.lit(None).cast("string"), "err_code": F.lit(None).cast("string"),
                                  "seconds": F.lit(0).cast("long")})
    t = tasks.join(call_outcomes.select(*TASK_KEY, "stage", "err_message", "err_detail", "err_code", "seconds"), TASK_KEY, "left")
    place = F.struct("server_id", "pk_id_pgini")
    ends = t.filter(F.col("stage") == CONNECT).groupBy("run_ts").agg(F.min(place).alias("_end"))
    return t.join(ends, "run_ts", "left").filter(F.col("_end").isNull() | (place <= F.col("_end"))).drop("_end")


def calls_made(called: DataFrame) -> DataFrame:
    """The tasks of ``reached_tasks`` whose remote call took place."""
    return called.filter(~F.coalesce(F.col("stage"), F.lit("")).isin(DISCONNECT, CONNECT))


def slice_results(report: DataFrame, listing: DataFrame, called: DataFrame | None = None) -> DataFrame:
    """The remote slicer's reply per task.

    0 listed files -> no reply (all fields NULL); more than one -> error / exception;
    exactly one -> report_ready with the slice size when the slice has lines, else
    report_file_missing with size -1. ``called`` (see ``reached_tasks``) restricts the
    report to calls that took place; one that failed gives error / exception with its
    message and code, the others their seconds. Sizes are 64 bits wide throughout: a slice
    of 2 GiB or more is ready like any other.
    """
    lc = listing.groupBy("server_id", "run_ts").agg(
        F.count(F.lit(1)).alias("n_files"), F.min("name").alias("_name"),
        F.min("size").alias("_size"), F.min("modification").alias("_modf"))
    r = report.join(lc, ["server_id", "run_ts"], "left")
    if called is None:
        r = r.withColumns({"stage": F.lit(None), "err_message": F.lit(None), "err_code": F.lit(None), "seconds": F.lit(0)})
    else:
        took_place = F.coalesce(~F.col("stage").isin(DISCONNECT, CONNECT), F.lit(True))
        r = r.join(called.filter(took_place).select(*TASK_KEY, "stage", "err_message", "err_code", "seconds"), TASK_KEY)
    failed = F.coalesce(F.col("stage") == CALL, F.lit(False))
    n = F.coalesce(F.col("n_files"), F.lit(0))
    many = (n > 1) & ~failed
    error = failed | many
    one = (n == 1) & ~failed
    ready = one & (F.col("line_count") > 0)
    return r.select(
        *TASK_KEY,
        F.when(error, F.lit(STATUS_ERROR)).alias("status"),
        F.when(error, F.lit(STATUS_EXCEPTION)).when(ready, F.lit(STATUS_READY))
        .when(one, F.lit(STATUS_MISSING)).alias("status_text"),
        F.when(ready, F.lit(REPORT_READY)).when(one, F.lit(REPORT_MISSING)).alias("report"),
        F.when(one, F.col("_name")).alias("full_log_name"),
        F.when(one, F.col("_size")).cast("long").alias("full_log_size"),
        F.when(one, F.col("_modf")).alias("full_log_modf"),
        F.when(ready, F.col("slice_bytes")).when(one, F.lit(-1)).cast("long").alias("slice_file_size"),
        F.when(many, F.lit(TOO_MANY_ROWS_MESSAGE)).when(failed, F.col("err_message")).alias("message"),
        F.when(many, F.lit(TOO_MANY_ROWS_SQLSTATE)).when(failed, F.col("err_code")).alias("sqlstate"),
        F.when(one, F.coalesce(F.col("seconds"), F.lit(0))).cast("long").alias("timer_seconds"),
    )


def json_time(ts) -> "F.Column":
    """A UTC time as the hub's JSON has it: ``2024-01-15T12:00:00.5+00:00``, the fraction
    without trailing zeros."""
    fraction = F.regexp_replace(F.date_format(ts, ".SSSSSS"), r"\.?0+$", "")
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("+00:00"))


def envelope_json(results: DataFrame) -> DataFrame:
    """The reply as the JSON object the hub receives (error shape or five-field shape)."""
    err = F.to_json(F.struct(F.col("status"), F.col("status_text"), F.col("message"), F.col("sqlstate")), KEEP_NULLS)
    ok = F.to_json(F.struct("full_log_name", "full_log_size", json_time(F.col("full_log_modf")).alias("full_log_modf"),
                            "slice_file_size", "status_text"), KEEP_NULLS)
    return results.withColumn("reply", F.when(F.col("status") == STATUS_ERROR, err)
                              .when(F.col("status_text").isNotNull(), ok))


REPLY_SCHEMA = ("status string, status_text string, message string, sqlstate string, full_log_name string, "
                "full_log_size long, full_log_modf string, slice_file_size long")


def read_replies(replies: DataFrame) -> DataFrame:
    """The fields of the JSON ``reply``, parsed once, beside the task key and timer."""
    r = replies.select(*TASK_KEY, "timer_seconds", F.from_json("reply", REPLY_SCHEMA).alias("_r"))
    return (r.select(*TASK_KEY, "timer_seconds", "_r.*")
            .withColumn("full_log_modf", F.to_timestamp("full_log_modf").cast("timestamp_ntz")))


def departures(tasks: DataFrame) -> DataFrame:
    """The argument object of each remote call, as VARIANT ``departure``."""
    at = "yyyy-MM-dd HH:mm:ss"
    return tasks.select(*TASK_KEY, F.to_variant_object(F.struct(
        F.col("pgbg_path"), F.col("log_path").alias("log_file"), F.col("out_dir").alias("out_dir_slice"), F.col("compl_name").alias("out_file_slice"),
        F.date_format("window_start", at).alias("begin_dattime"), F.date_format("window_end", at).alias("end_dattime"))).alias("departure"))


def variant_text(v, key: str):
    """A field as text, as JSONB's ``->>`` gives it: numbers and booleans in their digits and
    names, objects and arrays as JSON, NULL for a null, an unknown key or no object."""
    field = F.try_variant_get(v, f"$.{key}", "variant")
    return F.coalesce(F.try_variant_get(v, f"$.{key}", "string"), F.when(~F.is_variant_null(field), F.to_json(field)))


def read_variant_replies(replies: DataFrame) -> DataFrame:
    """``read_replies`` for replies of any shape: fields may be missing, unknown or more than
    the hub's, and numbers may come as text. Of a key given twice the last value counts. A
    reply that is no JSON, or a number or time that is none, gives NULL."""
    replies.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    r = replies.select(*TASK_KEY, "timer_seconds", F.try_parse_json("reply").alias("_v"))
    text = lambda key: variant_text(F.col("_v"), key)
    return r.select(*TASK_KEY, "timer_seconds", *[text(k).alias(k) for k in ("status", "status_text", "message", "sqlstate", "full_log_name")],
                    *[text(k).try_cast("long").alias(k) for k in ("full_log_size", "slice_file_size")],
                    F.try_to_timestamp(text("full_log_modf")).cast("timestamp_ntz").alias("full_log_modf"))


def route(results: DataFrame) -> dict[str, DataFrame]:
    """Error replies -> slicer error rows; report_ready -> ledger updates; the rest
    (no reply, report_file_missing) -> neither, exposed as ``unrouted``. ``results`` may come
    from ``slice_results`` or, over JSON, from ``read_replies``."""
    is_err = F.coalesce(F.col("status") == STATUS_ERROR, F.lit(False))
    is_ready = F.coalesce(F.col("status_text") == STATUS_READY, F.lit(False))
    errors = results.filter(is_err).select(
        F.col("server_id").alias("fk_pk_id_conn"), "pk_id_pgini", F.col("run_ts").alias("slice_now_ins"),
        F.col("message").alias("slice_err_mess"), F.col("status").alias("slice_err_detail"),
        F.col("sqlstate").alias("slice_err_code"), F.col("status_text").alias("work_scheme"))
    updates = results.filter(is_ready).select(
        *TASK_KEY, epoch_seconds(F.col("full_log_modf")).alias("log_mod"),
        F.col("timer_seconds").alias("log_timer_slicing"), F.col("full_log_size").alias("log_size"),
        F.col("slice_file_size").alias("log_slice_size"), F.col("full_log_name").alias("log_name"))
    unrouted = results.filter(~is_err & ~is_ready).select(*TASK_KEY, "status", "status_text")
    return {"errors": errors, "updates": updates, "unrouted": unrouted}


def hub_failures(called: DataFrame, updates: DataFrame, scheme: str) -> DataFrame:
    """The failures on the hub's own side, as slicer error rows labelled ``scheme``.
    A failed update counts where there was something to update."""
    hub = called.filter(F.col("stage").isin(DISCONNECT, CONNECT)).unionByName(
        called.filter(F.col("stage") == UPDATE).join(updates.select(*TASK_KEY), TASK_KEY, "left_semi").select(*called.columns))
    return hub.select(F.col("server_id").alias("fk_pk_id_conn"), "pk_id_pgini", F.col("run_ts").alias("slice_now_ins"),
                      F.col("err_message").alias("slice_err_mess"), F.col("err_detail").alias("slice_err_detail"),
                      F.col("err_code").alias("slice_err_code"), F.lit(scheme).alias("work_scheme"))


def route_label(results: DataFrame) -> DataFrame:
    """W27 in one pass: each reply labelled ``error`` / ``update`` / ``none`` (the three
    classes of ``route`` without reading the replies three times)."""
    is_err = F.coalesce(F.col("status") == STATUS_ERROR, F.lit(False))
    is_ready = F.coalesce(F.col("status_text") == STATUS_READY, F.lit(False))
    return results.select(*TASK_KEY, F.when(is_err, F.lit("error")).when(is_ready, F.lit("update"))
                          .otherwise(F.lit("none")).alias("route"), "status", "status_text")


def open_slices(tasks: DataFrame) -> DataFrame:
    """W28 (open): the ledger row written for each task before the remote call."""
    return tasks.select(
        *TASK_KEY, F.col("server_id").alias("fk_pk_id_conn"), epoch_seconds(F.col("run_ts")).alias("ins_date"),
        F.lit(0).cast("long").alias("log_mod"), F.lit(0).cast("long").alias("log_timer_slicing"),
        F.lit(0).cast("long").alias("log_size"), F.lit(0).cast("long").alias("log_slice_size"),
        F.lit(LEDGER_LOG_NAME_DEFAULT).alias("log_name"), F.col("compl_name").alias("log_slice_name"))


def fold_slices(opened: DataFrame, updates: DataFrame) -> DataFrame:
    """W28 (fold): opened rows with the update of their task applied (append-only ledger:
    the current state is the opened row overlaid by its update, by key)."""
    u = updates.select(*TASK_KEY, *[F.col(c).alias(f"_u_{c}") for c in
                                    ("log_mod", "log_timer_slicing", "log_size", "log_slice_size", "log_name")])
    j = opened.join(u, TASK_KEY, "left")
    return j.select(*TASK_KEY, "fk_pk_id_conn", "ins_date",
                    *[F.coalesce(F.col(f"_u_{c}"), F.col(c)).alias(c) for c in
                      ("log_mod", "log_timer_slicing", "log_size", "log_slice_size", "log_name")],
                    "log_slice_name")

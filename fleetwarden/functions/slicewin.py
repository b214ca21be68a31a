"""The two-hour log-slice window chosen from a run time (UTC wall clock, TIMESTAMP_NTZ).

Run time of day         log file day   window
00:00:00-00:05:00       yesterday      yesterday 22:00:00 -> today 00:00:00
(00:05:00-00:10:00]     yesterday      yesterday 22:00:00 -> yesterday 23:59:59 (last second included)
otherwise               today          hour(run) - 2h     -> hour(run)
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The schedule's limits in seconds after midnight, and the slice width.
LATE_RUN_END_SECONDS = 600        # 00:10:00, inclusive: still slices yesterday's log
NEAR_HOUR_SECONDS = 300           # within 5 minutes after the hour: slice the hour grid
SLICE_HOURS = 2
LOG_NAME_PREFIX = "postgresql-"
LOG_NAME_SUFFIX = ".log"


def _seconds_since(ts: Column, unit: str) -> Column:
    """Seconds (with microseconds) between ``date_trunc(unit, ts)`` and ``ts``."""
    micros = F.unix_micros(ts.cast("timestamp")) - F.unix_micros(F.date_trunc(unit, ts).cast("timestamp"))
    return micros / F.lit(1_000_000.0)


def window_columns(run_ts: Column) -> dict[str, Column]:
    day = F.date_trunc("day", run_ts).cast("timestamp_ntz")
    hour = F.date_trunc("hour", run_ts).cast("timestamp_ntz")
    since_midnight = _seconds_since(run_ts, "day")
    since_hour = _seconds_since(run_ts, "hour")
    late = since_midnight <= LATE_RUN_END_SECONDS          # first rule: yesterday's log
    on_grid = since_hour <= NEAR_HOUR_SECONDS               # second rule overrides the window
    yesterday = F.date_sub(F.to_date(run_ts), 1)
    grid_start = hour - F.expr(f"INTERVAL {SLICE_HOURS} HOURS")
    y_start = day - F.expr("INTERVAL 2 HOURS")
    y_end = day - F.expr("INTERVAL 1 SECOND")
    use_grid = on_grid | ~late
    log_day = F.when(late, yesterday).otherwise(F.to_date(run_ts))
    start = F.when(use_grid, grid_start).otherwise(y_start)
    return {
        "log_day": log_day,
        "log_name": F.concat(F.lit(LOG_NAME_PREFIX), F.date_format(log_day, "EEE"), F.lit(LOG_NAME_SUFFIX)),
        "window_start": start,
        "window_end": F.when(use_grid, hour).otherwise(y_end),
        "end_inclusive": ~use_grid,
        "window_crosses_file": F.to_date(start) != log_day,
    }


def effective_end(window_end: Column, end_inclusive: Column) -> Column:
    """Exclusive upper bound: the end itself, or one second later when its last second counts."""
    return F.when(end_inclusive, window_end + F.expr("INTERVAL 1 SECOND")).otherwise(window_end)

"""Local-calendar column functions.

Storage is UTC ``timestamp_ntz``; every report is in the report time zone.
``convert_timezone`` maps the instant to local wall-clock time, so the spring
gap hour never appears and the autumn hour appears twice.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


_UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00", "UTC+00:00"}


def _session_is_utc() -> bool:
    from pyspark.sql import SparkSession

    s = SparkSession.getActiveSession()
    return s is not None and s.conf.get("spark.sql.session.timeZone") in _UTC_NAMES


def local_ts(ts="ts", tz: str = C.REPORT_TIMEZONE) -> Column:
    """UTC timestamp_ntz -> local wall-clock timestamp_ntz.

    Both forms apply the zone's rules per instant (spring gap skipped, autumn
    hour repeated).  ``from_utc_timestamp`` is about 5x cheaper per row than
    ``convert_timezone`` but goes through the session time zone when casting,
    so it is used only when the session zone is UTC (read at plan time).
    """
    if _session_is_utc():
        return F.from_utc_timestamp(col(ts).cast("timestamp"), tz).cast("timestamp_ntz")
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), col(ts))


def utc_ntz_to_instant(ts="ts") -> Column:
    """UTC wall-clock timestamp_ntz -> TIMESTAMP (instant), whatever the session zone.

    Needed where Spark requires TIMESTAMP, e.g. stream watermarks and windows.
    The microseconds since the epoch come from the wall clock's own fields, so
    no session zone (nor its clock changes) takes part.
    """
    t = col(ts)
    minutes = (F.unix_date(F.to_date(t)).cast("bigint") * 24 + F.hour(t)) * 60 + F.minute(t)
    return F.timestamp_micros(minutes * 60_000_000 + (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("bigint"))


def instant_to_utc_ntz(t) -> Column:
    """TIMESTAMP (instant) -> its UTC wall clock as timestamp_ntz."""
    zero = F.lit(0)
    seconds = (F.unix_micros(col(t)).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + F.make_dt_interval(zero, zero, zero, seconds)


def local_calendar_columns(ts="ts", tz: str = C.REPORT_TIMEZONE) -> dict[str, Column]:
    """Columns day / month / year / hour of the local time of ``ts`` (F1)."""
    lt = local_ts(ts, tz)
    return {
        "day": F.to_date(lt),
        "month": F.month(lt),
        "year": F.year(lt),
        "hour": F.hour(lt),
    }


def day_type(local) -> Column:
    """weekend for Saturday/Sunday of the local date, else weekday (F2).

    Spark numbers Sunday as 1 and Saturday as 7.
    """
    return F.when(F.dayofweek(col(local)).isin(1, 7), F.lit("weekend")).otherwise(F.lit("weekday"))


def is_holiday(local) -> Column:
    code = F.month(col(local)) * 100 + F.dayofmonth(col(local))
    return code.isin([m * 100 + d for m, d in C.HOLIDAYS])


def day_type_holiday(local) -> Column:
    """holiday outranks weekend, which outranks weekday."""
    return F.when(is_holiday(local), F.lit("holiday")).otherwise(day_type(local))


def day_type_factor(dtype) -> Column:
    f = C.DAY_TYPE_FACTORS
    d = col(dtype)
    return (
        F.when(d == "holiday", F.lit(f["holiday"]))
        .when(d == "weekend", F.lit(f["weekend"]))
        .otherwise(F.lit(f["weekday"]))
    )


def season(month) -> Column:
    """12,1,2 winter; 3-5 spring; 6-8 summer; else autumn."""
    m = col(month)
    return (
        F.when(m.isin(12, 1, 2), F.lit("winter"))
        .when(m.isin(3, 4, 5), F.lit("spring"))
        .when(m.isin(6, 7, 8), F.lit("summer"))
        .otherwise(F.lit("autumn"))
    )


def season_factor(season_col) -> Column:
    s = col(season_col)
    f = C.SEASONAL_FACTORS
    return (
        F.when(s == "winter", F.lit(f["winter"]))
        .when(s == "spring", F.lit(f["spring"]))
        .when(s == "summer", F.lit(f["summer"]))
        .otherwise(F.lit(f["autumn"]))
    )


def local_day_filter(df, start_day: str | None, end_day: str | None, ts="ts", day="day"):
    """Closed local-day range ``start <= day <= end`` plus the UTC pruning bound."""
    if start_day is None and end_day is None:
        return df
    cond = F.lit(True)
    if start_day is not None:
        cond = cond & (col(ts) >= F.to_timestamp_ntz(F.lit(start_day)) - F.expr("INTERVAL 1 DAY"))
        cond = cond & (col(day) >= F.to_date(F.lit(start_day)))
    if end_day is not None:
        cond = cond & (col(ts) < F.to_timestamp_ntz(F.lit(end_day)) + F.expr("INTERVAL 2 DAYS"))
        cond = cond & (col(day) <= F.to_date(F.lit(end_day)))
    return df.filter(cond)


def utc_range_filter(df, start: str | None, end: str | None, ts="ts"):
    """Half-open UTC range ``start <= ts < end`` (repository range scans)."""
    if start is not None:
        df = df.filter(col(ts) >= F.to_timestamp_ntz(F.lit(start)))
    if end is not None:
        df = df.filter(col(ts) < F.to_timestamp_ntz(F.lit(end)))
    return df

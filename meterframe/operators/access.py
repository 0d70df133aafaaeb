"""Row access: counts, equality filters, range scans, latest / top-n."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..sources.io import scratch_path


def row_count(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows) for each named table; 0 for an empty one (B1)."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def filter_by_eq(df: DataFrame, **eq) -> DataFrame:
    """Conjunction of equality predicates; none means all rows."""
    cond = F.lit(True)
    for k, v in eq.items():
        cond = cond & (F.col(k) == F.lit(v))
    return df.filter(cond)


def first_by(df: DataFrame, order: str, **eq) -> DataFrame:
    """The first row (by ``order``) matching the predicates; deterministic LIMIT 1."""
    return filter_by_eq(df, **eq).orderBy(order).limit(1)


def get_or_raise(df: DataFrame, **key):
    """The one row with this key; KeyError without one, ValueError if the key is
    not unique (B3)."""
    rows = filter_by_eq(df, **key).take(2)
    if not rows:
        raise KeyError(f"no row with {key}")
    if len(rows) > 1:
        raise ValueError(f"more than one row with {key}")
    return rows[0]


def main_meter(meters: DataFrame, object_ids=None) -> DataFrame:
    """First meter of type main per site, by meter id."""
    m = meters.filter(F.col("type") == "main")
    if object_ids is not None:
        m = m.filter(F.col("object_id").isin(list(object_ids)))
    w = Window.partitionBy("object_id").orderBy("meter_id")
    return m.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


MEASUREMENT_PROJECTION = ["meter_id", "ts", "active_power_kw", "reactive_power_kvar", "energy_kwh", "power_factor"]
WEATHER_PROJECTION = [
    "object_id", "ts", "temperature_c", "solar_irradiance_wm2", "humidity_pct", "wind_speed_ms", "hdd", "cdd",
]


def range_scan(df: DataFrame, start=None, end=None, columns=None, ts: str = "ts", order: bool = False, **eq) -> DataFrame:
    """Rows with ``start <= ts < end`` (half-open), optional equality keys, projected.

    The bounds are literals on a stored column, so they reach the Parquet
    scan as pushed filters.  Rows come unordered by default: a global sort is
    only worth its shuffle at a report edge.
    """
    out = cal.utc_range_filter(filter_by_eq(df, **eq), start, end, ts)
    if columns:
        out = out.select(*columns)
    return out.orderBy(ts) if order else out


def latest(df: DataFrame, key: str = "object_id", ts: str = "ts") -> DataFrame:
    """Most recent row per key: max_by over a struct of all columns.

    A partial/final aggregate: each map task keeps one row per key.
    """
    cols = [c for c in df.columns if c != key]
    agg = df.groupBy(key).agg(F.max_by(F.struct(*cols), F.col(ts)).alias("_r"))
    return agg.select(key, *[F.col(f"_r.{c}").alias(c) for c in cols])


def last_n(df: DataFrame, n: int = 24, key: str = "meter_id", ts: str = "ts") -> DataFrame:
    """Top-n rows by ts descending per key (B11); it counts rows, not hours.

    ``row_number() <= n`` is planned with a partial WindowGroupLimit below
    the shuffle, so only n rows per key and map task are exchanged.
    """
    w = Window.partitionBy(key).orderBy(F.col(ts).desc())
    return df.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n)


def baseline_profile(baseline: DataFrame, object_id=None, month=None, day_type=None) -> DataFrame:
    """24-hour baseline for (site, month, day type), by hour."""
    b = baseline
    if object_id is not None:
        b = b.filter(F.col("object_id") == object_id)
    if month is not None:
        b = b.filter(F.col("month") == month)
    if day_type is not None:
        b = b.filter(F.col("day_type") == day_type)
    return b.select("object_id", "month", "day_type", "hour_of_day", "expected_kwh")


def newest_first(months: list, read, keys: DataFrame, n: int = 1, key: str = "meter_id", ts: str = "ts") -> DataFrame:
    """The last n rows of each key (B10, B11) of a fact stored by month, read
    from its newest month backwards and only until every key has its n rows.

    ``months`` lists the stored months in any order that sorts by time, ``read``
    opens one; ``keys`` (one column, ``key``) are the keys asked for.  A key that
    has its rows is dropped by an anti join before the next month is opened, so a
    month is read for the keys that still lack rows.  Each month's finds are
    written to the shared folder: what was read is not read again.  A key with
    fewer rows than n makes the search go back to the first month.
    """
    spark = keys.sparkSession
    path = scratch_path(spark, "newest-first")
    wanted, found = keys.select(key).distinct(), None
    for step, month in enumerate(sorted(months, reverse=True)):
        rows = read(month).join(wanted, key, "left_semi")
        last_n(rows, n, key, ts).drop("rn").write.parquet(f"{path}/{step}")
        found = spark.read.parquet(*(f"{path}/{i}" for i in range(step + 1)))
        full = found.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") >= n).select(key)
        lacking = keys.select(key).distinct().join(full, key, "left_anti")
        if lacking.isEmpty():
            break
        wanted = lacking
    if found is None:
        raise ValueError("there is no month to read")
    return last_n(found, n, key, ts)

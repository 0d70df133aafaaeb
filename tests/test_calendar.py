"""Local-time edge rows (spring gap, autumn repeat, year edge, zone edges)."""

import datetime as dt

from pyspark.sql import functions as F

from meterframe.functions import calendar as cal
from meterframe.functions import tariffs as tf


def _local(spark, stamps):
    df = spark.createDataFrame([(dt.datetime.fromisoformat(s),) for s in stamps], "ts timestamp_ntz")
    cols = cal.local_calendar_columns("ts")
    return df.select("ts", cal.local_ts("ts").alias("lt"), *[v.alias(k) for k, v in cols.items()]).orderBy("ts").collect()


def test_spring_gap(spark):
    rows = _local(spark, ["2025-03-30 00:00:00", "2025-03-30 01:00:00"])
    assert [r.hour for r in rows] == [2, 4]


def test_autumn_repeat(spark):
    rows = _local(spark, ["2025-10-26 00:00:00", "2025-10-26 01:00:00"])
    assert [r.hour for r in rows] == [3, 3]
    assert rows[0].day == rows[1].day == dt.date(2025, 10, 26)


def test_year_edge(spark):
    (r,) = _local(spark, ["2025-12-31 22:00:00"])
    assert (r.year, r.month, r.day, r.hour) == (2026, 1, dt.date(2026, 1, 1), 0)


def test_first_day_starts_at_two(spark):
    (r,) = _local(spark, ["2025-01-01 00:00:00"])
    assert r.hour == 2 and r.day == dt.date(2025, 1, 1)


def test_day_type_weekend(spark):
    df = spark.createDataFrame([(dt.date(2025, 1, 4),), (dt.date(2025, 1, 5),), (dt.date(2025, 1, 6),)], "d date")
    got = [r[0] for r in df.select(cal.day_type("d")).collect()]
    assert got == ["weekend", "weekend", "weekday"]


def test_holiday_outranks_weekend(spark):
    # 2025-06-28 is a Saturday and a holiday; 2025-01-07 a Tuesday holiday.
    df = spark.createDataFrame([(dt.date(2025, 6, 28),), (dt.date(2025, 1, 7),), (dt.date(2025, 1, 8),)], "d date")
    got = [r[0] for r in df.select(cal.day_type_holiday("d")).collect()]
    assert got == ["holiday", "holiday", "weekday"]


def test_zone_edges(spark):
    df = spark.createDataFrame([(6,), (7,), (22,), (23,)], "h int")
    got = [r[0] for r in df.select(tf.tariff_zone("h")).collect()]
    assert got == ["night", "day", "day", "night"]


def test_rate_map_matches_zone_rule(spark):
    """F6 (range lookup with midnight wrap) equals F5 on all 24 hours."""
    m = tf.hourly_rate_map(tf.tariff_zones(spark)).orderBy("hour").collect()
    assert len(m) == 24
    for r in m:
        day = 7 <= r.hour <= 22
        assert r.zone_type == ("day" if day else "night")
        assert r.rate_uah_kwh == (6.9 if day else 5.6)


def test_local_day_filter_prunes_by_utc(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 3, 1, 23),)], "ts timestamp_ntz").withColumn(
        "day", F.to_date(cal.local_ts("ts"))
    )
    out = cal.local_day_filter(df, "2025-03-02", "2025-03-02").collect()
    assert len(out) == 1  # 23:00 UTC is the next local day

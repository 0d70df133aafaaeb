"""The bucketed table of site hours: no exchange, equal rows, hot sites."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from meterframe.operators import analytics as an
from meterframe.operators import views as vw
from meterframe.sources import buckets as B


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return Counter(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def hours(stored):
    return stored.site_hours


def test_views_of_site_hours_equal_the_joins(stored, hours):
    assert rows(vw.level_2_of_hours(hours)) == rows(vw.level_2_consumption(stored.measurements, stored.meters))
    assert rows(vw.level_3_of_hours(hours)) == rows(vw.level_3_consumption(stored.measurements, stored.meters, stored.solar, stored.battery))
    l1 = vw.level_1_consumption(stored.site_readings, stored.meters)
    days = ("2025-02-10", "2025-11-03")
    assert rows(an.balance_of_hours(hours, *days)) == rows(an.solar_battery_balance(l1, stored.solar, stored.battery, *days))


@pytest.mark.parametrize("make", [vw.level_2_of_hours, vw.level_3_of_hours, an.balance_of_hours])
def test_no_exchange(hours, make):
    p = plan(make(hours))
    assert "Exchange" not in p and "Join" not in p and "Bucketed: true" in p


def test_a_range_of_days_reaches_the_scan(spark, stored):
    key = "spark.sql.maxMetadataStringLength"
    old = spark.conf.get(key)
    spark.conf.set(key, "4000")
    p = plan(an.balance_of_hours(stored.between("2025-03-01", "2025-03-31").site_hours, "2025-03-01", "2025-03-31"))
    spark.conf.set(key, old)
    assert "GreaterThanOrEqual(day,2025-03-01)" in p and "Exchange" not in p


def test_another_session_opens_the_files(spark, stored, hours):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{stored.root}/site_hours_{n}"
    other = spark.newSession()
    spark.sql(f"DROP TABLE {B.table_name(path)}")  # the files stay
    again = B.open_site_hours(other, path, n)
    assert again.count() > 0 and "Exchange" not in plan(vw.level_2_of_hours(again))


def test_two_mains_telemetry_twice_and_none(spark, tmp_path):
    """Rows multiply as in the joins; a hot site is dealt out by its days."""
    t0 = dt.datetime(2025, 5, 1)
    at = lambda h: t0 + dt.timedelta(hours=h)
    meters = [(1, 1, "M", "main", 1, "x"), (2, 1, "M2", "main", 1, "x"), (3, 1, "Z", "zone", 2, "x"), (4, 1, "S", "solar", 3, "x"), (5, 1, "B", "battery", 3, "x"), (6, 2, "Z", "zone", 2, "x")]
    meas = [(1, at(0), 1.0, 10.0), (2, at(0), 1.0, 0.0), (3, at(0), 1.0, 5.0), (4, at(0), 1.0, 2.0), (5, at(0), 1.0, 3.0), (6, at(0), 1.0, 4.0), (4, at(1), 1.0, 2.0), (3, None, 1.0, 1.0)]
    meas += [(m, at(h), 1.0, float(h)) for m in (1, 3) for h in range(24, 24 * 200)]
    solar, battery = [(1, at(0), 7.0, 7.0), (1, at(0), 8.0, 8.0), (9, at(0), 1.0, 1.0)], [(1, at(0), 50.0, -4.0, 4.0, "discharging")]
    f = spark.createDataFrame
    m = f(meters, "meter_id int, object_id int, name string, type string, level smallint, location string")
    r = f(meas, "meter_id int, ts timestamp_ntz, active_power_kw double, energy_kwh double").withColumn("power_factor", F.lit(0.9))
    s = f(solar, "object_id int, ts timestamp_ntz, power_kw double, energy_kwh double")
    b = f(battery, "object_id int, ts timestamp_ntz, soc_pct double, power_kw double, energy_kwh double, mode string")
    hours = B.write_site_hours(B.site_hours(r, m, s, b), f"{tmp_path}/hours", 6)
    assert rows(vw.level_2_of_hours(hours)) == rows(vw.level_2_consumption(r, m))
    assert rows(vw.level_3_of_hours(hours)) == rows(vw.level_3_consumption(r, m, s, b))
    assert rows(an.balance_of_hours(hours)) == rows(an.solar_battery_balance(vw.level_1_consumption(r, m), s, b))
    sizes = [n.n for n in hours.filter("object_id = 1").groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 6 and max(sizes) < 2 * sum(sizes) / 6

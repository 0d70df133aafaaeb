"""Cross-query invariants on the sf0.001 fixture."""

from pyspark.sql import functions as F

from meterframe.operators import analytics as an
from meterframe.operators import jobs
from meterframe.operators import views as vw


def total(df, col):
    return df.agg(F.sum(col)).collect()[0][0]


def test_daily_monthly_hourly_sums_agree(tables):
    l1 = vw.level_1_consumption(tables.measurements_nocum, tables.meters)
    h = total(l1, "energy_kwh")
    d = total(an.daily_consumption(l1), "total_kwh")
    m = total(vw.monthly_energy_cost(l1), "total_kwh")
    assert h == d == m


def test_day_plus_night_is_total(tables):
    l1 = vw.level_1_consumption(tables.measurements_nocum, tables.meters)
    m = vw.monthly_energy_cost(l1).select(
        (F.col("day_kwh") + F.col("night_kwh") - F.col("total_kwh")).alias("d")
    )
    assert m.filter(F.abs("d") > 1e-9).count() == 0


def test_cumulative_last_value_is_sum(tables):
    cum = jobs.cumulative_totalizer(tables.measurements_nocum.select("meter_id", "ts", "energy_kwh"))
    last = cum.groupBy("meter_id").agg(F.max_by("cumulative_kwh", "ts").alias("last"), F.sum("energy_kwh").alias("s"))
    assert last.filter(F.abs(F.col("last") - F.col("s")) > 1e-6).count() == 0


def test_running_sum_chunks_equal_plain_window(tables):
    from pyspark.sql import Window

    m = tables.measurements_nocum.select("meter_id", "ts", "energy_kwh")
    a = jobs.running_sum(m, "energy_kwh", "meter_id", out="r")
    w = Window.partitionBy("meter_id").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    b = m.withColumn("r2", F.sum("energy_kwh").over(w))
    j = a.join(b, ["meter_id", "ts"])
    assert j.filter(F.col("r") != F.col("r2")).count() == 0
    assert j.count() == m.count()


def test_single_sample_baseline(spark):
    import datetime as dt

    l1 = spark.createDataFrame(
        [(1, dt.datetime(2025, 1, 6, 10), 1, 12, "weekday", 5.0)],
        "object_id int, ts timestamp_ntz, month int, hour int, day_type string, energy_kwh double",
    )
    w = spark.createDataFrame([(1, dt.datetime(2025, 1, 6, 10), -3.0)], "object_id int, ts timestamp_ntz, temperature_c double")
    r = jobs.baseline_from(l1, w).collect()[0]
    assert (r.expected_kwh, r.std_dev_kwh, r.temperature_coeff, r.sample_count) == (5.0, 0.0, 0.0, 1)


def test_cost_zero_for_empty_range(tables):
    from meterframe.operators import service as sv

    h = sv.hourly_consumption(tables.measurements_nocum, tables.meters, "2030-01-01", "2030-02-01")
    out = sv.calculate_cost(h, tables.objects, tables.tariff_zones).collect()
    assert len(out) == 3 and all(r.total_uah == 0.0 and r.day_kwh == 0.0 for r in out)


def test_zone_share_null_when_main_zero(spark):
    import datetime as dt

    from meterframe.operators.views import level_2_consumption

    ts = dt.datetime(2025, 1, 6, 10)
    meas = spark.createDataFrame(
        [(1, ts, 0.0, 0.0), (2, ts, 1.0, 1.0)], "meter_id int, ts timestamp_ntz, active_power_kw double, energy_kwh double"
    )
    meters = spark.createDataFrame(
        [(1, 1, "m", "main", 1, "x"), (2, 1, "z", "zone", 2, "y")],
        "meter_id int, object_id int, name string, type string, level short, location string",
    )
    (r,) = level_2_consumption(meas, meters).collect()
    assert r.share_pct is None


def test_first_by_is_deterministic(tables):
    from meterframe.operators import access as ac

    r = ac.first_by(tables.meters, "meter_id", type="main").collect()
    assert len(r) == 1 and r[0].meter_id == 1


def test_change_violations_flag_missing_and_duplicate_keys(spark):
    import datetime as dt

    ts = dt.datetime(2025, 1, 1)
    base = spark.createDataFrame([(1, ts, 1.0)], "meter_id int, ts timestamp_ntz, energy_kwh double")
    ch = spark.createDataFrame(
        [(1, ts, 2.0, "U"), (2, ts, 1.0, "D"), (1, ts, 3.0, "I"), (3, ts, 1.0, "I")],
        "meter_id int, ts timestamp_ntz, energy_kwh double, op string",
    )
    bad = sorted((r.meter_id, r.op) for r in jobs.change_violations(base, ch, ["meter_id", "ts"]).collect())
    assert bad == [(1, "I"), (2, "D")]


def change_frames(spark, changes):
    import datetime as dt

    day = lambda m: dt.datetime(2025, m, 1)
    base = spark.createDataFrame([(i, day(m), float(i)) for i in (1, 2, 3) for m in (1, 2)], "meter_id int, ts timestamp_ntz, energy_kwh double")
    return base, spark.createDataFrame([(i, day(m), e, op) for i, m, e, op in changes], "meter_id int, ts timestamp_ntz, energy_kwh double, op string")


def test_change_set_applies_once_per_key(spark):
    base, changes = change_frames(spark, [(1, 1, 9.0, "U"), (2, 1, None, "D"), (4, 2, 4.0, "I")])
    out = jobs.apply_changes(base, changes, ["meter_id", "ts"])
    got = sorted((r.meter_id, r.ts.month, r.energy_kwh) for r in out.collect())
    assert got == [(1, 1, 9.0), (1, 2, 1.0), (2, 2, 2.0), (3, 1, 3.0), (3, 2, 3.0), (4, 2, 4.0)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan and "LeftAnti" in plan


def test_impossible_changes_are_rejected(spark):
    import pytest

    for bad in ([(1, 1, 2.0, "U"), (1, 1, 3.0, "U")], [(9, 1, 2.0, "U")], [(9, 1, 2.0, "D")], [(1, 1, 2.0, "I")], [(1, 1, 2.0, "X")]):
        base, changes = change_frames(spark, bad)
        with pytest.raises(ValueError):
            jobs.apply_changes(base, changes, ["meter_id", "ts"])


def test_running_sum_keeps_rows_without_key_or_time(spark):
    import datetime as dt

    ts = dt.datetime(2025, 1, 1)
    df = spark.createDataFrame([(1, ts, 1.0), (None, ts, 2.0), (1, None, 4.0)], "meter_id int, ts timestamp_ntz, energy_kwh double")
    got = {(r.meter_id, r.ts): r.cumulative_kwh for r in jobs.cumulative_totalizer(df).collect()}
    assert len(got) == 3 and got[None, ts] == 2.0 and got[1, ts] in (1.0, 5.0)


def readings_of(spark, rows):
    import datetime as dt

    ts = dt.datetime(2025, 1, 6, 10)
    return spark.createDataFrame([(m, ts, e, e) for m, e in rows], "meter_id int, ts timestamp_ntz, active_power_kw double, energy_kwh double")


def meters_of(spark, rows):
    from meterframe import schemas

    return spark.createDataFrame([(m, s, f"m{m}", t, lv, None, None, True, None) for m, s, t, lv in rows], schemas.METERS)


def test_every_zone_meter_has_a_column(spark):
    from meterframe.operators import service as sv

    meters = meters_of(spark, [(1, 1, "main", 1), *[(m, 1, "zone", 2) for m in (2, 3, 4, 9)], (20, 2, "zone", 2)])
    wide = sv.zone_consumption_wide(readings_of(spark, [(1, 9.0), (2, 1.0), (4, 2.0), (9, 3.0), (9, 2.5), (20, 5.0)]), meters)
    got = {r.object_id: r for r in wide.collect()}
    assert [got[1][f"z{i}_energy_kwh"] for i in (1, 2, 3, 4)] == [1.0, None, 2.0, 3.0]
    assert [got[2][f"z{i}_energy_kwh"] for i in (1, 2, 3, 4)] == [5.0, None, None, None]


def test_zone_split_allocates_site_days(spark, tables):
    from meterframe.operators import service as sv

    meters = meters_of(spark, [(1, 1, "main", 1), (2, 1, "zone", 2), (3, 1, "zone", 2)])
    readings = readings_of(spark, [(1, 10.0), (2, 4.0)]).withColumn("power_factor", F.lit(1.0))
    l1 = vw.level_1_consumption(readings, meters)
    got = {r.zone_no: (round(r.allocated_kwh, 9), r.metered_kwh) for r in sv.zone_split(l1, readings, meters, [0.5, 0.2]).collect()}
    assert got == {0: (3.0, None), 1: (5.0, 4.0), 2: (2.0, None)}


def test_zone_share_has_a_row_for_each_main_meter(spark):
    meters = meters_of(spark, [(1, 1, "main", 1), (2, 1, "main", 1), (3, 1, "zone", 2), (4, 2, "zone", 2)])
    readings = readings_of(spark, [(1, 10.0), (2, 20.0), (3, 5.0), (4, 1.0)])
    got = sorted((r.object_id, r.share_pct) for r in vw.level_2_consumption(readings, meters).collect() if r.object_id == 1)
    assert got == [(1, 25.0), (1, 50.0)]
    (alone,) = [r for r in vw.level_2_consumption(readings, meters).collect() if r.object_id == 2]
    assert alone.share_pct is None


def test_sites_and_readings_grow_with_the_data(spark, tables):
    from meterframe.sources.fixtures import MeterTables

    larger = MeterTables(spark, "/root/testdata/sf0.01")
    assert larger.objects.count() > 5 * tables.objects.count()
    assert larger.readings.count() > 5 * tables.readings.count()

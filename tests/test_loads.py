"""Loads that go on from earlier ones: running totals and baseline moments."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from meterframe.operators import jobs, views

T0 = dt.datetime(2025, 1, 1)
KIND = "meter_id int, ts timestamp_ntz, energy_kwh double"


def series(seed=1):
    rng = random.Random(seed)
    rows = [(rng.choice([1, 1, 1, 2, 3, None]), T0 + dt.timedelta(hours=h), rng.choice([None, 1.0, 2.5, 0.0, 7.0])) for h in range(0, 6000, 7)]
    return rows + [(1, None, 4.0)]


def loaded(spark, parts):
    """Running totals of the parts, each from the stored totals of those before."""
    stored, out = None, []
    for rows in parts:
        df = spark.createDataFrame(rows, KIND)
        totals = jobs.chunk_totals(df, "energy_kwh", "meter_id")
        out += jobs.resumed_totalizer(df, totals.limit(0) if stored is None else stored).collect()
        stored = totals if stored is None else stored.unionByName(totals)
    return sorted(map(tuple, out), key=str)


@pytest.mark.parametrize("cuts", [[300, 500], [1], [], [856], [400, 401, 402]])
def test_loads_equal_one_load(spark, cuts):
    rows = series()
    rows = rows[-1:] + rows[:-1]  # without a time comes first
    whole = jobs.cumulative_totalizer(spark.createDataFrame(rows, KIND))
    edges = [0, *cuts, len(rows)]
    parts = [rows[a:b] for a, b in zip(edges, edges[1:])]
    assert loaded(spark, parts) == sorted(map(tuple, whole.collect()), key=str)


def test_months_that_begin_without_a_value(spark):
    """A running sum is NULL only until the first value, whatever the month."""
    rows = [(1, T0 + dt.timedelta(days=20 * i), v) for i, v in enumerate([None, 2.0, None, None, 3.0, None])]
    want = [None, 2.0, 2.0, 2.0, 5.0, 5.0]
    whole = jobs.cumulative_totalizer(spark.createDataFrame(rows, KIND)).orderBy("ts").collect()
    assert [r.cumulative_kwh for r in whole] == want
    for cut in range(1, 6):
        assert [r[3] for r in sorted(loaded(spark, [rows[:cut], rows[cut:]]), key=lambda r: r[1])] == want


def test_a_load_of_a_new_meter_and_an_empty_load(spark):
    first, second = [(1, T0, 2.0)], [(2, T0 + dt.timedelta(days=40), 3.0)]
    assert loaded(spark, [first, [], second]) == [(1, T0, 2.0, 2.0), (2, T0 + dt.timedelta(days=40), 3.0, 3.0)]


def test_a_load_reads_no_row_of_earlier_loads(spark, tmp_path):
    rows = series()
    for name, part in (("old", rows[:500]), ("new", rows[500:-1])):
        spark.createDataFrame(part, KIND).write.parquet(f"{tmp_path}/{name}")
    jobs.chunk_totals(spark.read.parquet(f"{tmp_path}/old"), "energy_kwh", "meter_id").write.parquet(f"{tmp_path}/totals")
    df = jobs.resumed_totalizer(spark.read.parquet(f"{tmp_path}/new"), spark.read.parquet(f"{tmp_path}/totals"))
    assert df.count() == len(rows) - 501
    assert not any("/old/" in f for f in df.inputFiles())


def test_cycles_resumed(spark):
    rng = random.Random(3)
    kind = "object_id int, ts timestamp_ntz, mode string, power_kw double"
    rows = [(rng.choice([1, 2]), T0 + dt.timedelta(hours=5 * h), rng.choice(["charging", "discharging", "idle", None]), rng.uniform(-9, 9)) for h in range(600)]
    whole = {r[:2]: r.cycle_count for r in jobs.battery_cycles(spark.createDataFrame(rows, kind)).collect()}
    old, new = spark.createDataFrame(rows[:250], kind), spark.createDataFrame(rows[250:], kind)
    got = jobs.resumed_cycles(new, jobs.chunk_totals(old, jobs.discharged(), "object_id")).collect()
    assert len(got) == 350 and all(r.cycle_count == pytest.approx(whole[r[:2]], abs=1e-4) for r in got)


def test_merged_moments_equal_a_rebuild(spark, tables):
    l1 = views.level_1_consumption(tables.site_readings, tables.meters)
    # A large common level: sums of squares would lose the spread.
    l1 = l1.withColumn("energy_kwh", F.col("energy_kwh") + 1e7)
    whole = {r[:4]: r[4:] for r in jobs.baseline_from(l1, tables.weather).collect()}
    part = F.dayofyear("day") % 4
    states = None
    for n in range(4):
        s = jobs.baseline_states(l1.filter(part == n), tables.weather)
        states = s if states is None else states.unionByName(s)
    got = {r[:4]: r[4:] for r in jobs.baseline_of(states).collect()}
    assert got.keys() == whole.keys()
    for k, v in whole.items():
        assert got[k] == pytest.approx(v, abs=2e-4)


def test_moments_of_odd_groups(spark):
    kind = "object_id int, ts timestamp_ntz, month int, hour int, day_type string, energy_kwh double"
    rows = [(1, T0 + dt.timedelta(days=d), 1, 0, "weekday", e) for d, e in enumerate([5.0, None, 7.0])] + [(2, T0, 1, 0, "weekday", 1.0), (3, T0, 1, 0, "weekday", None)]
    weather = [(1, T0 + dt.timedelta(days=d), t) for d, t in enumerate([1.0, 2.0, None])] + [(2, T0, 4.0), (3, T0, 4.0)]
    l1, w = spark.createDataFrame(rows, kind), spark.createDataFrame(weather, "object_id int, ts timestamp_ntz, temperature_c double")
    whole = sorted(map(tuple, jobs.baseline_from(l1, w).collect()), key=str)
    one = jobs.baseline_states(l1.filter("day(ts) = 1"), w).unionByName(jobs.baseline_states(l1.filter("day(ts) > 1"), w))
    assert sorted(map(tuple, jobs.baseline_of(one).collect()), key=str) == whole
    assert jobs.baseline_of(jobs.baseline_states(l1.limit(0), w)).collect() == []

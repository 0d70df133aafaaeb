"""Weather hours are made by all tasks and never broadcast, however few bytes
the site ids take."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterframe.operators import jobs
from meterframe.plans.catalog_more import _fill_base, _g1m
from meterframe.sources.fixtures import HOURS, MeterTables


@pytest.fixture()
def sites(spark, tmp_path):
    """Ten sites of four suppliers, each with a few line items."""
    spark.range(40).select(F.col("id").alias("s_suppkey")).write.parquet(f"{tmp_path}/supplier.parquet")
    day = dt.datetime(1994, 3, 1)
    spark.createDataFrame(
        [(k, p, s, k % 7, float(1 + k % 5), day + dt.timedelta(days=k % 40)) for k, (s, p) in enumerate((s, p) for s in range(40) for p in range(12))],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_shipdate timestamp",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    return MeterTables(spark, str(tmp_path))


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_weather_hours_are_made_by_several_tasks(sites):
    made = sites.weather.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in made) == 10 * HOURS
    assert len(made) > 1


def test_weather_is_not_broadcast(sites):
    l1 = sites.site_readings.filter("meter_type = 'main'").select(
        "object_id", "ts", F.month("ts").alias("month"), F.hour("ts").alias("hour"), F.lit("weekday").alias("day_type"), "energy_kwh"
    )
    for df in (jobs.baseline_from(l1, sites.weather), jobs.baseline_states(l1, sites.weather), jobs.with_hourly(_fill_base(sites), sites.weather_gappy, "temperature_c", how="left")):
        plan = final_plan(df)
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_merged_baseline_equals_the_baseline(sites):
    key = lambda r: tuple(r)[:4]
    whole, merged = (sorted(df.collect(), key=key) for df in (jobs.build_baseline(sites), _g1m(sites).select(*jobs.build_baseline(sites).columns)))
    assert [key(r) for r in whole] == [key(r) for r in merged] and len(whole) > 50
    for a, b in zip(whole, merged, strict=True):
        assert tuple(a)[4:] == pytest.approx(tuple(b)[4:], abs=2e-4)

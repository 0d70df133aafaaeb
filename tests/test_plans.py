"""Plan-shape tests: the physical plans we want at scale."""

import json

import pytest
from pyspark.sql import functions as F

from meterframe.operators import access as ac
from meterframe.operators import analytics as an
from meterframe.operators import views as vw




def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_meter_dimension_is_broadcast(stored):
    l1 = vw.level_1_consumption(stored.measurements, stored.meters)
    p = plan(an.daily_consumption(l1, "2025-01-01", "2025-12-31"))
    assert "BroadcastHashJoin" in p


def test_zone_share_uses_one_shuffle_on_site_and_hour(stored):
    df = vw.level_2_consumption(stored.measurements, stored.meters)
    p = plan(df)
    shuffles = [line for line in p.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 1 and "object_id" in shuffles[0] and "ts" in shuffles[0]


def test_top_k_uses_partial_window_group_limit(stored):
    l1 = vw.level_1_consumption(stored.measurements, stored.meters)
    top = an.top_anomalies(an.anomaly_detection(an.baseline_comparison(l1, stored.baseline)), 20)
    df = top.select("object_id", "rank")
    df.write.format("noop").mode("overwrite").save()
    assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString() or "WindowGroupLimit" in plan(df)


def test_range_scan_pushes_ts_bounds(stored):
    df = ac.range_scan(stored.measurements, "2025-03-01", "2025-04-01", ac.MEASUREMENT_PROJECTION, order=False)
    p = plan(df)
    assert "PushedFilters" in p and "GreaterThanOrEqual(ts" in p and "LessThan(ts" in p
    assert "cumulative_kwh" not in p.split("ReadSchema")[1].split("\n")[0]


def test_local_day_filter_adds_utc_bound(stored):
    l1 = vw.level_1_consumption(stored.measurements, stored.meters)
    p = plan(an.daily_consumption(l1, "2025-03-01", "2025-03-31"))
    assert "GreaterThanOrEqual(ts" in p


def _windows(df):
    js = json.loads(df._jdf.queryExecution().optimizedPlan().toJSON())
    return [n for n in js if n.get("class", "").endswith("logical.Window")]


def test_no_unpartitioned_window_in_any_query(spark):
    from meterframe.plans.registry import all_queries

    from tests.conftest import SF_SMALL

    skip = {"bulk_load", "idempotent_load", "scan_measurements", "report_csv", "stream_hourly_rollup", "stream_anomaly", "stream_dedup"}
    for name, q in all_queries().items():
        if name in skip:
            continue
        for w in _windows(q(spark, SF_SMALL)):
            assert w.get("partitionSpec"), f"{name}: window without PARTITION BY"


def test_short_range_prunes_partitions(stored):
    """A one-month report on the stored tables reads only its months' partitions."""
    from pyspark.sql import functions as F

    march = stored.between("2025-03-01", "2025-03-31")
    l1 = vw.level_1_consumption(march.measurements, march.meters)
    df = an.daily_consumption(l1, "2025-03-01", "2025-03-31")
    p = plan(df)
    scan = [line for line in p.splitlines() if "Scan parquet" in line and "measurements" in line][0]
    assert "PartitionFilters: []" not in scan
    full = an.daily_consumption(vw.level_1_consumption(stored.measurements, stored.meters), "2025-03-01", "2025-03-31")
    key = ["object_id", "day"]
    assert sorted(map(tuple, df.orderBy(*key).collect())) == sorted(map(tuple, full.orderBy(*key).collect()))
    assert 31 <= df.count() <= 3 * 31


def test_scan_works_on_unpartitioned_tables(spark, stored, tmp_path):
    from meterframe import schemas
    from meterframe.sources import io

    flat = str(tmp_path / "flat")
    stored.measurements.write.parquet(flat)
    a = io.scan(spark, flat, schemas.MEASUREMENTS, "2025-03-01", "2025-04-01").count()
    b = ac.range_scan(stored.measurements, "2025-03-01", "2025-04-01", order=False).count()
    assert a == b > 0
    part = str(tmp_path / "part")
    io.bulk_load(stored.measurements, part)
    df = io.scan(spark, part, schemas.MEASUREMENTS, "2025-03-01", "2025-04-01")
    assert df.count() == b
    assert "PartitionFilters: []" not in plan(df)


def test_baseline_join_is_broadcast_when_small(stored):
    """The baseline (576 rows per site) is broadcast by Spark's own size
    estimate -- no hint -- so a large fleet falls back to a shuffle join."""
    l1 = vw.level_1_consumption(stored.measurements, stored.meters)
    p = plan(an.baseline_comparison(l1, stored.baseline, "2025-01-01", "2025-12-31"))
    joins = [line for line in p.splitlines() if "Join" in line and "LeftOuter" in line]
    assert joins and all("BroadcastHashJoin" in j for j in joins)


def test_idempotent_load_on_flat_table(spark, stored, tmp_path):
    from meterframe import schemas
    from meterframe.sources import io

    flat = str(tmp_path / "flat_idem")
    stored.measurements.write.parquet(flat)  # not partitioned by year/month
    io.idempotent_load(spark, stored.measurements, flat, schemas.MEASUREMENTS, ["meter_id", "ts"])
    assert spark.read.parquet(flat).count() == stored.measurements.count()


def test_scan_prunes_months_and_honours_the_time_column(spark, stored, tmp_path):
    from meterframe import schemas
    from meterframe.sources import io

    part = str(tmp_path / "months")
    io.bulk_load(stored.measurements, part)
    df = io.scan(spark, part, schemas.MEASUREMENTS, "2025-03-01", "2025-04-01")
    files = df.select(F.input_file_name().alias("f")).distinct().collect()
    assert {r.f.split("month=")[1].split("/")[0] for r in files} == {"3"}
    assert "month#" in [line for line in plan(df).splitlines() if "PartitionFilters" in line][0].split("PartitionFilters")[1].split("PushedFilters")[0]
    flat = str(tmp_path / "metrics")
    stored.daily_metrics.write.parquet(flat)
    days = io.scan(spark, flat, schemas.DAILY_METRICS, "2025-03-01", "2025-04-01", ts="date")
    assert {r.date.month for r in days.select("date").collect()} == {3}


def test_bulk_load_writes_few_sorted_files(spark, stored, tmp_path):
    from meterframe.sources import io

    path = str(tmp_path / "bulk")
    io.bulk_load(stored.measurements.repartition(16), path)
    files = [r.f for r in spark.read.parquet(path).select(F.input_file_name().alias("f")).distinct().collect()]
    assert len(files) <= 3 * 13
    ts = [r.ts for r in spark.read.parquet(files[0].replace("file://", "")).collect()]
    assert ts == sorted(ts)


def test_idempotent_load_takes_a_repeated_key_once(spark, stored, tmp_path):
    from meterframe import schemas
    from meterframe.sources import io

    path = str(tmp_path / "idem")
    batch = stored.measurements.limit(5)
    io.idempotent_load(spark, batch.unionByName(batch), path, schemas.MEASUREMENTS, ["meter_id", "ts"])
    assert spark.read.parquet(path).count() == 5


def test_balance_uses_one_exchange(stored):
    l1 = vw.level_1_consumption(stored.site_readings, stored.meters)
    p = plan(an.solar_battery_balance(l1, stored.solar, stored.battery, "2025-01-01", "2025-12-31"))
    shuffles = [line for line in p.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 1 and "day" in shuffles[0]


def test_site_reports_need_no_meter_join(stored):
    l1 = vw.level_1_consumption(stored.site_readings, stored.meters)
    assert "Join" not in plan(an.daily_consumption(l1, "2025-01-01", "2025-12-31"))


def test_range_scans_are_unordered_by_default(stored):
    assert "rangepartitioning" not in plan(ac.range_scan(stored.measurements, "2025-03-01", "2025-04-01"))


def test_stored_tables_know_their_input_and_zone(spark, tables):
    from meterframe.sources.fixtures import MeterTables
    from meterframe.sources.store import input_version

    kyiv = input_version(tables)
    assert kyiv == input_version(MeterTables(spark, tables.sf_dir))
    assert kyiv != input_version(MeterTables(spark, tables.sf_dir, tz="America/New_York"))
    assert kyiv != input_version(MeterTables(spark, "/root/testdata/sf0.01"))


def test_reports_are_ordered_and_single_files_bounded(spark, stored, tmp_path, monkeypatch):
    from meterframe.sources import io

    path = str(tmp_path / "r")
    df = spark.range(20).selectExpr("cast(id % 5 as int) AS object_id", "id AS v").repartition(4)
    io.report_csv(df, path, order=["object_id", "v"], single_file=True)
    got = [(int(r.object_id), int(r.v)) for r in spark.read.option("header", True).csv(path).collect()]
    assert got == sorted(got)
    monkeypatch.setattr(io, "SINGLE_FILE_ROWS", 10)
    with pytest.raises(ValueError):
        io.report_csv(df, path, single_file=True)

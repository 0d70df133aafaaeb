"""Stored layouts and loads: newest month first, meters together, rules counted
by the load, reports with a byte order mark, get or raise."""

import datetime as dt
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from meterframe.operators import access as ac
from meterframe.operators import quality as qa
from meterframe.sources import io
from meterframe.sources.months import MonthTable

KIND = "meter_id int, ts timestamp_ntz, energy_kwh double"
day = lambda m, d=1: dt.datetime(2025, m, d)


def month_table(spark, path, rows):
    df = spark.createDataFrame(rows, KIND)
    t = MonthTable(spark, str(path), df.schema, ["meter_id", "ts"])
    t.create(df)
    return t


@pytest.mark.parametrize("n,opened", [(1, [12]), (2, [12]), (3, [12, 11]), (5, [12, 11, 10])])
def test_newest_month_first(spark, tmp_path, n, opened):
    rows = [(i, day(m, d), float(m)) for i in (1, 2, 3) for m in range(1, 13) for d in (1, 9)]
    t = month_table(spark, tmp_path / "t", rows)
    read = []

    def open_(month):
        read.append(month.month)
        return t.open([month])

    keys = spark.createDataFrame([(1,), (2,), (2,), (3,)], "meter_id int")
    got = ac.newest_first(t.months(), open_, keys, n)
    assert read == opened
    want = ac.last_n(t.read(), n)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_keys_that_lack_rows_are_searched_alone(spark, tmp_path):
    rows = [(1, day(m, d), 1.0) for m in range(1, 7) for d in range(1, 20)] + [(2, day(2), 5.0), (3, day(6), 6.0), (None, day(6), 6.0)]
    t = month_table(spark, tmp_path / "t", rows)
    keys = spark.createDataFrame([(1,), (2,), (4,)], "meter_id int")  # 4 has no row, 3 is not asked for
    seen = {}

    def open_(month):
        df = t.open([month])
        seen[month.month] = df
        return df

    got = sorted((r.meter_id, r.ts, r.rn) for r in ac.newest_first(t.months(), open_, keys, 2).collect())
    assert got == [(1, day(6, 18), 2), (1, day(6, 19), 1), (2, day(2), 1)]
    assert sorted(seen) == [1, 2, 3, 4, 5, 6]
    with pytest.raises(ValueError):
        ac.newest_first([], open_, keys)


def test_meters_lie_together(spark, tmp_path):
    """One meter's month is in a few row groups of the clustered layout."""
    df = spark.range(40_000).select((F.col("id") % 200).cast("int").alias("meter_id"), (F.lit(day(3)) + F.make_interval(mins=F.col("id").cast("int"))).cast("timestamp_ntz").alias("ts"), F.lit(1.0).alias("energy_kwh"))

    def met(path, meter):
        """(row groups that may hold the meter, all row groups)."""
        some = total = 0
        for f in Path(path).rglob("*.parquet"):
            meta = pq.ParquetFile(f).metadata
            for g in range(meta.num_row_groups):
                s = next(c.statistics for c in (meta.row_group(g).column(i) for i in range(meta.num_columns)) if c.path_in_schema == "meter_id")
                total += 1
                some += s.min <= meter <= s.max
        return some, total

    io.bulk_load(df, f"{tmp_path}/time", max_records_per_file=2000)
    io.bulk_load(df, f"{tmp_path}/meter", cluster="meter_id", files=8, max_records_per_file=2000)
    for meter in (0, 77, 199):
        some, total = met(f"{tmp_path}/meter", meter)
        assert total >= 20 and some <= 3
        by_time, all_ = met(f"{tmp_path}/time", meter)
        assert by_time == all_
    one = spark.read.parquet(f"{tmp_path}/meter").filter("meter_id = 77")
    assert one.count() == 200 and spark.read.parquet(f"{tmp_path}/meter").count() == 40_000


def test_rules_are_counted_by_the_load(spark, tables, tmp_path):
    dirty = tables.dirty_measurements
    got = qa.observed_load(dirty, "measurements", lambda df: io.bulk_load(df, f"{tmp_path}/load"))
    loaded = io.scan(spark, f"{tmp_path}/load", dirty.schema)
    assert loaded.count() == dirty.count() == got.first().rows
    found = {(r.kind, r.rule): r.violations for r in got.collect()}
    checks = {r.rule: r.violations for r in qa.check_violations({"measurements": loaded}).collect()}
    nulls = {r.column_name: r.violations for r in qa.null_violations({"measurements": loaded}).collect()}
    assert {k[1]: v for k, v in found.items() if k[0] == "check"} == checks and sum(checks.values()) > 0
    assert {k[1]: v for k, v in found.items() if k[0] == "not null"} == nulls and nulls["active_power_kw"] > 0
    meters = qa.observed_load(tables.meters, "meters", lambda df: df.write.parquet(f"{tmp_path}/meters"))
    assert {(r.kind, r.rule) for r in meters.collect()} >= {("allowed value", "type"), ("check", "ck_meter_level")}


def test_reports_begin_with_a_byte_order_mark(spark, tmp_path):
    df = spark.createDataFrame([(2, "б"), (1, "а")], "object_id int, name string")
    io.report_csv(df, f"{tmp_path}/bom", ["object_id"], single_file=True)
    (f,) = Path(f"{tmp_path}/bom").glob("*.csv")
    assert f.read_bytes() == "﻿object_id,name\n1,а\n2,б\n".encode()
    assert [tuple(r) for r in io.read_csv(spark, f"{tmp_path}/bom", df.schema).orderBy("object_id").collect()] == [(1, "а"), (2, "б")]
    io.report_csv(df, f"{tmp_path}/plain", single_file=True, bom=False)
    (f,) = Path(f"{tmp_path}/plain").glob("*.csv")
    assert f.read_bytes().startswith(b"object_id,")


def test_get_or_raise(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "object_id int, name string")
    assert ac.get_or_raise(df, object_id=1).name == "a"
    assert ac.get_or_raise(df, object_id=2, name="c").name == "c"
    with pytest.raises(KeyError):
        ac.get_or_raise(df, object_id=3)
    with pytest.raises(ValueError):
        ac.get_or_raise(df, object_id=2)

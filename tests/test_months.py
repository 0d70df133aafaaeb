"""Change sets written back: versions, untouched files, failed jobs."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from meterframe.operators import jobs
from meterframe.sources import months as M

KIND = "meter_id int, ts timestamp_ntz, energy_kwh double"
KEY = ["meter_id", "ts"]
day = lambda m, d=1, y=2025: dt.datetime(y, m, d)


def table(spark, path, rows):
    base = spark.createDataFrame(rows, KIND)
    t = M.MonthTable(spark, str(path), base.schema, KEY)
    t.create(base)
    return t


def changes(spark, rows):
    return spark.createDataFrame(rows, f"{KIND}, op string")


def contents(df):
    return sorted(((r.meter_id, r.ts, r.energy_kwh) for r in df.collect()), key=str)


ROWS = [(i, day(m, d), float(i * m)) for i in (1, 2, 3) for m in (1, 2, 3) for d in (1, 2)] + [(9, None, 1.0)]


def files(t, version=None):
    return {(m.year, m.month): sorted(f.name for f in Path(m.path).glob("*.parquet")) for m in t.months(version)}


def test_only_touched_months_are_rewritten(spark, tmp_path):
    t = table(spark, tmp_path / "t", ROWS)
    before = files(t)
    set_ = changes(spark, [(1, day(2), 50.0, "U"), (2, day(2), None, "D"), (7, day(2, 9), 7.0, "I"), (7, day(4), 8.0, "I")])
    assert t.apply(set_) == 2
    after = files(t)
    assert set(after) == {(2025, 1), (2025, 2), (2025, 3), (2025, 4), (-1, -1)}
    for same in ((2025, 1), (2025, 3), (-1, -1)):
        assert after[same] == before[same]
    assert after[2025, 2] != before[2025, 2]
    base = spark.createDataFrame(ROWS, KIND)
    assert contents(t.read()) == contents(jobs.apply_changes(base, set_, KEY))
    assert contents(t.read(version=1)) == contents(base)  # the version before is still there


def test_a_month_can_become_empty(spark, tmp_path):
    t = table(spark, tmp_path / "t", [(1, day(1), 1.0), (1, day(2), 2.0)])
    t.apply(changes(spark, [(1, day(2), None, "D")]))
    assert files(t).keys() == {(2025, 1)}
    t.apply(changes(spark, [(1, day(1), None, "D")]))
    assert t.read().collect() == [] and t.versions() == [1, 2, 3]
    t.apply(changes(spark, [(1, day(5), 3.0, "I")]))
    assert contents(t.read()) == [(1, day(5), 3.0)]


def test_a_failed_job_leaves_the_table(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path / "t", ROWS)
    before = contents(t.read())
    for bad in ([(1, day(1), 2.0, "I")], [(5, day(1), 2.0, "U")], [(1, day(1), 2.0, "U"), (1, day(1), 3.0, "U")]):
        with pytest.raises(ValueError):
            t.apply(changes(spark, bad))
    with monkeypatch.context() as m:
        m.setattr(M.MonthTable, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            t.apply(changes(spark, [(1, day(1), 2.0, "U")]))
    fails = F.udf(lambda x: 1 / 0, "double")
    with pytest.raises(Exception):
        t.apply(changes(spark, [(1, day(1), 2.0, "U")]).withColumn("energy_kwh", fails("energy_kwh")))
    assert contents(t.read()) == before and t.versions() == [1]
    assert t.apply(changes(spark, [(1, day(1), 2.0, "U")])) == 2  # and may be run again


def test_the_second_of_two_writers_fails(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path / "t", ROWS)
    with monkeypatch.context() as m:
        m.setattr(M.MonthTable, "versions", lambda self: [1])
        t.apply(changes(spark, [(1, day(1), 2.0, "U")]))
        with pytest.raises(Exception, match="EXISTS|exists"):
            t.apply(changes(spark, [(2, day(1), 2.0, "U")]))
    assert [r for r in contents(t.read()) if r[1] == day(1)] == [(1, day(1), 2.0), (2, day(1), 2.0), (3, day(1), 3.0)]


def test_a_range_opens_its_months_only(spark, tmp_path):
    t = table(spark, tmp_path / "t", ROWS)
    got = t.read("2025-02-02", "2025-03-02")
    assert contents(got) == sorted([(i, day(2, 2), 2.0 * i) for i in (1, 2, 3)] + [(i, day(3, 1), 3.0 * i) for i in (1, 2, 3)], key=str)
    assert all("month=2" in f or "month=3" in f for f in got.inputFiles())
    assert contents(t.read("2025-03-01")) == contents(t.read().filter(F.col("ts") >= F.lit("2025-03-01").cast("timestamp_ntz")))
    with pytest.raises(ValueError):
        t.read(version=7)


def test_tables_must_have_their_time_in_the_key(spark, tmp_path):
    with pytest.raises(ValueError):
        M.MonthTable(spark, str(tmp_path), spark.createDataFrame([], KIND).schema, ["meter_id"])
    with pytest.raises(ValueError):
        M.MonthTable(spark, str(tmp_path / "none"), spark.createDataFrame([], KIND).schema, KEY).apply(changes(spark, [(1, day(1), 1.0, "I")]))
    t = table(spark, tmp_path / "t", [])
    assert t.read().collect() == []
    with pytest.raises(ValueError):
        t.create(spark.createDataFrame(ROWS, KIND))


def test_the_check_of_changes_does_not_shuffle_the_fact(spark, stored):
    """Only touched months are read, and rows of other keys stop at the semi join."""
    base = stored._restrict(spark.read.parquet(f"{stored.root}/measurements")).select("meter_id", "ts", "energy_kwh")
    rows = [(r.meter_id, r.ts, 1.0, "U") for r in base.filter("month(ts) = 3").limit(20).collect()]
    set_ = changes(spark, rows)
    df = jobs.change_violations(base, set_, KEY)
    assert df.collect() == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    scan = [line for line in plan.splitlines() if "DataFilters" in line][0]
    assert "month" in scan

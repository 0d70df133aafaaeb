"""Streaming operators: source layouts, several micro-batches, batch equality."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterframe.streaming import rollup as st
from tests.conftest import SF_SMALL


def events_dir(spark, path, rows):
    """A data folder whose events are these (event_id, ts, user_id, value), in scattered files."""
    folder = str(path)
    df = spark.createDataFrame([(i, t, u, "x", v, None) for i, t, u, v in rows], st.EVENTS_SCHEMA)
    df.repartition(3).write.parquet(f"{folder}/events.parquet")
    return folder


def rolled(spark, folder, **kw):
    return {tuple(r) for r in st.hourly_rollup(spark, folder, **kw).select("meter", "window_start", "readings").collect()}


def test_folder_and_file_layouts_agree(spark, tmp_path):
    folder = str(tmp_path / "data")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(3).write.parquet(f"{folder}/events.parquet")
    a, b = rolled(spark, folder), rolled(spark, SF_SMALL)
    assert a == b and len(a) > 0


def test_rollup_equals_batch_aggregate(spark):
    b = st.readings_batch(spark, SF_SMALL).groupBy("meter", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("window_start")).agg(
        F.count(F.lit(1)).alias("readings")
    )
    want = {tuple(r) for r in b.collect()}
    assert rolled(spark, SF_SMALL) == want
    assert rolled(spark, SF_SMALL, max_files_per_trigger=1) == want  # many micro-batches


def test_state_holds_the_lateness_not_history(spark):
    """Files follow event time, so old keys leave the state as the stream goes on."""
    feed = st.time_ordered_feed(spark, SF_SMALL, spans=12)
    assert feed.lateness == st.LATENESS
    s = st.reading_stream(spark, feed.path, 1).withWatermark("ets", feed.lateness)
    run = st._run(s.dropDuplicatesWithinWatermark(["meter", "ets"]).select("event_id"), spark, "bounded", SF_SMALL, "append")
    sink = spark.read.parquet(run.sink)
    total = st.readings_batch(spark, SF_SMALL).count()
    assert len({r.batch_id for r in sink.select("batch_id").distinct().collect()}) >= 12
    assert sink.count() == st.readings_batch(spark, SF_SMALL).select("meter", "ts").distinct().count()
    assert 0 < run.state_rows < total / 4  # two spans of twelve and an hour
    # One batch after the other is later than the one before.
    spans = st.as_readings(spark.read.schema(st.EVENTS_SCHEMA).parquet(feed.path)).groupBy(F.input_file_name().alias("f")).agg(F.min("ts"), F.max("ts")).orderBy("f").collect()
    assert len(spans) == 12 and all(a[2] <= b[1] for a, b in zip(spans, spans[1:]))


def test_state_is_kept_in_rocksdb_and_settings_come_back(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    feed = st.time_ordered_feed(spark, SF_SMALL, spans=2)
    s = st.reading_stream(spark, feed.path, 1).withWatermark("ets", feed.lateness).dropDuplicatesWithinWatermark(["meter", "ets"])
    run = st._run(s.select("event_id"), spark, "state", SF_SMALL, "append")
    assert spark.conf.get(key, None) == before
    names = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(run.sink.replace("/sink", "/checkpoint/state")).select("path").collect()
    assert any(r.path.endswith(".changelog") for r in names)


def test_a_store_without_file_times_gets_the_whole_extent(spark, monkeypatch):
    monkeypatch.setattr(st, "_in_order_of_names", lambda spark, folder: False)
    lateness = int(st.time_ordered_feed(spark, SF_SMALL).lateness.split()[0])
    first, last = st.readings_batch(spark, SF_SMALL).agg(F.min("ts"), F.max("ts")).first()
    assert lateness >= (last - first).total_seconds()


def test_events_without_a_time_are_kept(spark, tmp_path):
    t = dt.datetime(2025, 5, 1, 10)
    rows = [(1, t, 1, 1.0), (2, None, 1, 2.0), (3, None, 1, 4.0), (4, None, 2, 8.0), (5, t, 1, 1.0), (6, None, None, 3.0)]
    folder = events_dir(spark, tmp_path / "d", rows)
    got = {tuple(r) for r in st.hourly_rollup(spark, folder).collect()}
    assert got == {(1, t, 2.0, 2), (1, None, 6.0, 2), (2, None, 8.0, 1), (None, None, 3.0, 1)}
    kept = {(r.event_id, r.ts, r.meter) for r in st.dedup_stream(spark, folder).collect()}
    assert {k for k in kept if k[1] is None} == {(2, None, 1), (4, None, 2), (6, None, None)}
    assert len(kept) == 4
    only = events_dir(spark, tmp_path / "e", [r for r in rows if r[1] is None])
    assert {tuple(r) for r in st.hourly_rollup(spark, only).collect()} == {(1, None, 6.0, 2), (2, None, 8.0, 1), (None, None, 3.0, 1)}


def test_dedup_keeps_every_reading_once(spark, tmp_path):
    t = dt.datetime(2025, 10, 26, 0, 30)
    rows = [(i, t + dt.timedelta(minutes=7 * i), i % 3, float(i)) for i in range(40)]
    rows += [(100 + i, *rows[i][1:]) for i in (0, 5, 39)]  # sent again
    folder = events_dir(spark, tmp_path / "d", rows)
    for files in (1, 64):
        got = st.dedup_stream(spark, folder, max_files_per_trigger=files).collect()
        assert sorted((r.meter, r.ts, r.value) for r in got) == sorted((u, ts, v) for _, ts, u, v in rows[:40])
        assert all(r.event_id in (int(r.value), 100 + int(r.value)) for r in got)


@pytest.mark.parametrize("zone", ["Europe/Kyiv", "America/New_York", "UTC"])
def test_hours_of_a_clock_change_stay_apart(spark, tmp_path, zone):
    """Both 00:30Z and 01:30Z on the day clocks go back, and the hour of the year that is skipped."""
    times = [dt.datetime(2025, 10, 26, h, 30) for h in (0, 1, 2)] + [dt.datetime(2025, 3, 30, h, 30) for h in (0, 1, 2)]
    times += [dt.datetime(2025, 11, 2, h, 30, 0, 123456) for h in (5, 6, 7)]
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        folder = events_dir(spark, tmp_path / "d", [(i, t, 1, 1.0) for i, t in enumerate(times)])
        want = {(1, t.replace(minute=0, second=0, microsecond=0), 1) for t in times}
        assert rolled(spark, folder) == want
        assert {r.ts for r in st.dedup_stream(spark, folder).collect()} == set(times)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_baseline_comes_from_the_past_only(spark, tmp_path):
    day = dt.datetime(2025, 5, 1, 10)
    rows = [(i, day + dt.timedelta(days=i), 1, 1.0) for i in range(10)] + [(90, day + dt.timedelta(days=9, minutes=5), 1, 50.0)]
    got = st.anomaly_stream(spark, events_dir(spark, tmp_path / "d", rows)).collect()
    assert [(r.event_id, r.expected) for r in got] == [(90, 1.0)]

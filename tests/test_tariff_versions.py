"""Tariffs with validity ranges against a lookup of one reading at a time."""

import datetime as dt
import random
from zoneinfo import ZoneInfo

import pytest

from meterframe.functions import tariffs as tf

VERSION = "object_id int, zone_id int, zone_type string, start_sec int, end_sec int, rate_uah_kwh double, is_active boolean, valid_from timestamp_ntz, valid_to timestamp_ntz"
READING = "object_id int, ts timestamp_ntz, energy_kwh double"
START, END = dt.datetime(2025, 1, 1), dt.datetime(2026, 1, 1)
KYIV = ZoneInfo("Europe/Kyiv")


def rate_of(site, ts, versions, lo=START, hi=END):
    """(zone id, type, rate) by the rule: smallest id, latest start, smallest rate."""
    if site is None or ts is None or not lo <= ts < hi:
        return None, "day", 6.9
    local = ts.replace(tzinfo=dt.timezone.utc).astimezone(KYIV)
    second = local.hour * 3600 + local.minute * 60 + local.second
    fits = []
    for o, zone, kind, s, e, rate, active, frm, to in versions:
        inside = s <= second < e if s < e else second >= s or second < e
        if o == site and active and inside and (frm is None or frm <= ts) and (to is None or ts < to):
            fits.append((zone, -(frm or dt.datetime.min).timestamp() if frm else float("inf"), rate, kind))
    if not fits:
        return None, "day", 6.9
    zone, _, rate, kind = min(fits)
    return zone, kind, rate


def nasty(seed=5):
    rng = random.Random(seed)
    moment = lambda: START + dt.timedelta(seconds=rng.randrange(-30 * 86400, 400 * 86400))
    versions = []
    for site in (1, 2, 3):
        for _ in range(14):
            a, b = sorted((moment(), moment()))
            s, e = rng.choice([(25200, 82800), (82800, 25200), (0, 86400), (1800, 1800), (36000, 36930), (3661, 80000)])
            versions.append((site, rng.choice([1, 1, 2, 3]), rng.choice(["day", "night", "peak"]), s, e, round(rng.uniform(1, 9), 2), rng.random() < 0.85,
                             rng.choice([a, a, a, None]), rng.choice([b, b, b, None])))
    versions += [(4, 1, "day", 0, 86400, 2.0, True, dt.datetime(2025, 3, 1), dt.datetime(2025, 3, 1)), (5, 1, "day", 0, 86400, 2.0, False, None, None)]
    versions += [versions[0], (None, 1, "day", 0, 86400, 0.5, True, None, None)]
    readings = [(rng.choice([1, 2, 3, 4, 5, 6]), moment().replace(microsecond=rng.choice([0, 999999])), float(i)) for i in range(1500)]
    for v in versions[:20]:  # exactly at the edges, and a moment before
        for t in v[7:9]:
            if t is not None:
                readings += [(v[0], t, 1.0), (v[0], t - dt.timedelta(microseconds=1), 1.0)]
    return versions, readings + [(None, START, 1.0), (1, None, 1.0), readings[0]]


def test_asof_rates(spark):
    versions, readings = nasty()
    got = tf.asof_tariffs(spark.createDataFrame(readings, READING), spark.createDataFrame(versions, VERSION), "2025-01-01", "2026-01-01", ["object_id"]).collect()
    assert len(got) == len(readings)
    want = sorted(((o, t, e, *rate_of(o, t, versions)) for o, t, e in readings), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want
    assert sum(w[3] is None for w in want) > 50 and len({w[5] for w in want}) > 20


def test_segments_do_not_overlap(spark):
    versions, _ = nasty(6)
    segments = tf.tariff_segments(spark.createDataFrame(versions, VERSION), "2025-01-01", "2026-01-01", ["object_id"]).collect()
    by = {}
    for s in segments:
        assert START <= s.seg_from < s.seg_to <= END
        assert all(a.to_sec <= b.from_sec for a, b in zip(s.slices, s.slices[1:]))
        by.setdefault(s.object_id, []).append((s.seg_from, s.seg_to))
    for spans in by.values():
        spans.sort()
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_one_tariff_for_all_sites(spark):
    versions = [(0, 1, "day", 25200, 82800, 6.9, True, None, None), (0, 2, "night", 82800, 25200, 5.6, True, None, dt.datetime(2025, 6, 1)), (0, 2, "night", 82800, 25200, 4.0, True, dt.datetime(2025, 6, 1), None)]
    _, readings = nasty(7)
    got = tf.asof_tariffs(spark.createDataFrame(readings, READING), spark.createDataFrame(versions, VERSION).drop("object_id"), "2025-01-01", "2026-01-01").collect()
    want = sorted(((o, t, e, *rate_of(0, t, versions)) for o, t, e in readings), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want


@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_readings_meet_segments_by_an_equality_join(spark, broadcast):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, broadcast)
    try:
        versions, readings = nasty()
        df = tf.asof_tariffs(spark.createDataFrame(readings, READING), spark.createDataFrame(versions, VERSION), "2025-01-01", "2026-01-01", ["object_id"])
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        assert df.count() == len(readings)
    finally:
        spark.conf.set(key, old)


def test_no_versions_no_readings(spark):
    none, no_readings = spark.createDataFrame([], VERSION), spark.createDataFrame([], READING)
    one = spark.createDataFrame([(1, START, 2.0)], READING)
    assert [tuple(r) for r in tf.asof_tariffs(one, none, "2025-01-01", "2026-01-01", ["object_id"]).collect()] == [(1, START, 2.0, None, "day", 6.9)]
    assert tf.asof_tariffs(no_readings, none, "2025-01-01", "2026-01-01", ["object_id"]).collect() == []
    bill = tf.asof_bill(tf.asof_tariffs(one, none, "2025-01-01", "2026-01-01", ["object_id"]), ["object_id"]).collect()
    assert [tuple(r) for r in bill] == [(1, 2025, 1, "day", 1, 1, 2.0, 13.8)]

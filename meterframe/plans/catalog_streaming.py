"""Registered queries for the streaming operators."""

from __future__ import annotations

from ..streaming import rollup as st
from .catalog import query

EVENT_READINGS = "(SELECT event_id, ts, user_id AS meter, value FROM events)"


@query(
    "stream_hourly_rollup",
    f"""SELECT meter, date_trunc('hour', ts) AS window_start, SUM(value) AS energy_kwh, COUNT(*) AS readings
    FROM {EVENT_READINGS} GROUP BY ALL""",
    ("energy_kwh",),
)
def _n1(t):
    return st.hourly_rollup(t.spark, t.sf_dir)


@query(
    "stream_anomaly",
    f"""WITH cut AS (SELECT date_trunc('day', min(ts) + (max(ts) - min(ts)) / 2) AS middle FROM events),
    base AS (
      SELECT meter, CAST(hour(ts) AS INTEGER) AS hour, round(AVG(value), 6) AS expected
      FROM {EVENT_READINGS}, cut WHERE ts < middle GROUP BY ALL)
    SELECT r.event_id, r.ts, r.meter, r.value, b.expected
    FROM cut, {EVENT_READINGS} r JOIN base b ON b.meter = r.meter AND b.hour = hour(r.ts)
    WHERE r.ts >= middle AND r.value > b.expected * CAST(2.0 AS DOUBLE)""",
    ("value", "expected"),
)
def _n2(t):
    return st.anomaly_stream(t.spark, t.sf_dir)


@query(
    "stream_dedup",
    f"""SELECT event_id, ts, meter, value FROM {EVENT_READINGS}
    QUALIFY ROW_NUMBER() OVER (PARTITION BY meter, ts ORDER BY event_id) = 1""",
    ("value",),
)
def _n3(t):
    return st.dedup_stream(t.spark, t.sf_dir)

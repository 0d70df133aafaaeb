"""Results do not depend on the session time zone."""

import pytest

import __spark_entry__ as E
from check_oracle import duck, rows_of

from tests.conftest import SF_SMALL

NAMES = ["level_1_consumption", "daily_consumption", "cumulative_totalizer", "weather_range", "stream_anomaly",
         "stream_hourly_rollup", "stream_dedup", "battery_cycles"]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_queries_under_other_session_zone(spark, zone):
    con = duck(SF_SMALL)
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for name in NAMES:
            df = E.queries()[name](spark, SF_SMALL)
            srows = [tuple(r) for r in df.collect()]
            res = con.execute(E.oracle_sql()[name])
            dcols = [d[0] for d in res.description]
            assert rows_of(df.columns, srows) == rows_of(dcols, res.fetchall()), name
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)

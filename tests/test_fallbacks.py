"""Results do not depend on the physical strategy or on the storage path."""

import pytest

import __spark_entry__ as E
from check_oracle import duck, rows_of

from tests.conftest import SF_SMALL

JOINY = ["level_1_consumption", "level_3_consumption", "baseline_comparison", "solar_battery_balance", "daily_metrics",
         "detect_anomalies", "orphans", "quarantine_split", "cascade_delete", "apply_changes"]


def test_without_broadcast_joins(spark):
    """Dimensions too large to broadcast: the shuffle-join plans give the same rows."""
    con = duck(SF_SMALL)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        for name in JOINY:
            df = E.queries()[name](spark, SF_SMALL)
            if name == "level_3_consumption":
                assert "SortMergeJoin" in df._jdf.queryExecution().executedPlan().toString()
            res = con.execute(E.oracle_sql()[name])
            assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(
                [d[0] for d in res.description], res.fetchall()
            ), name
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)




@pytest.mark.parametrize("name", ["daily_consumption", "level_2_consumption", "baseline_comparison", "daily_metrics",
                                  "cumulative_totalizer", "battery_range", "weather_range", "check_violations"])
def test_stored_tables_equal_derived(spark, tables, stored, name):
    from meterframe.plans.catalog import QUERY_FNS, finish

    a = finish(QUERY_FNS[name](tables))
    b = finish(QUERY_FNS[name](stored))
    assert rows_of(a.columns, [tuple(r) for r in a.collect()]) == rows_of(b.columns, [tuple(r) for r in b.collect()])

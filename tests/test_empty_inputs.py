"""Empty line items (sites still listed): queries return what the oracle returns
(no rows, or zeros where the operator defines them)."""

import pytest

import __spark_entry__ as E
from check_oracle import TABLES, duck, rows_of

from tests.conftest import SF_SMALL

NAMES = ["daily_consumption", "level_2_consumption", "calculate_cost", "specific_consumption_total", "annual_summary",
         "build_baseline", "daily_metrics", "cumulative_totalizer", "battery_range", "check_violations",
         "duplicate_keys", "orphans", "cascade_delete", "row_count", "stream_hourly_rollup", "stream_dedup", "stream_anomaly",
         "active_tariffs", "idempotent_load", "top_anomalies", "source_shares"]


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    for t in TABLES:
        df = spark.read.parquet(f"{SF_SMALL}/{t}.parquet")
        (df if t == "supplier" else df.limit(0)).coalesce(1).write.parquet(f"{d}/{t}.parquet")
    return d


@pytest.mark.parametrize("name", NAMES)
def test_empty_input(spark, empty_dir, name):
    df = E.queries()[name](spark, empty_dir)
    res = duck(empty_dir).execute(E.oracle_sql()[name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([d[0] for d in res.description], res.fetchall())

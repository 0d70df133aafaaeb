"""Every registered query equals its DuckDB oracle on the sf0.001 tables."""

import pytest

import __spark_entry__ as E
from meterframe.plans.registry import all_oracles, all_queries
from check_oracle import duck, norm, rows_of

from tests.conftest import SF_SMALL

NAMES = sorted(all_queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(all_oracles()) == set(all_queries())
    assert set(E.oracle_sql()) <= set(E.queries()) and set(all_queries()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["object_id", "day", "total_kwh", "peak_kw", "avg_kw", "cost_uah", "day_type"]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_of(df.columns, srows) == rows_of(dcols, drows)

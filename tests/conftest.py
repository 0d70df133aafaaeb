import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from meterframe.session import local_session

    s = local_session(cores=4, shuffle_partitions=4, app="meterframe-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from meterframe.sources.fixtures import MeterTables

    return MeterTables(spark, SF_SMALL)


@pytest.fixture(scope="session")
def stored(tables, tmp_path_factory):
    """The sf0.001 tables ingested once into partitioned Parquet."""
    from meterframe.sources.store import materialize

    return materialize(tables, root=str(tmp_path_factory.mktemp("stored")))

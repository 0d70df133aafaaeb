"""The change set's readings are derived once."""

from meterframe.plans.catalog_more import _change_set


def test_change_set_reads_stored_readings(tables):
    base, changes = _change_set(tables)
    for df in (base, changes):
        assert all("change-base" in f for f in df.inputFiles())

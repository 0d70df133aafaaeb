"""A load keeps the smallest row of a key and tells a stored batch by its keys."""

import datetime as dt

from meterframe import schemas
from meterframe.sources import io


def test_idempotent_load_keeps_the_smallest_row_and_appends_once(spark, tmp_path):
    ts = lambda d: dt.datetime(2025, 3, d)
    fields = ["meter_id", "ts", "active_power_kw", "energy_kwh"]
    schema = type(schemas.MEASUREMENTS)([schemas.MEASUREMENTS[f] for f in fields])
    schema = type(schema)([type(f)(f.name, f.dataType, True) for f in schema])
    batch = spark.createDataFrame([(1, ts(1), 2.0, 5.0), (1, ts(1), None, 9.0), (1, ts(1), 2.0, 4.0), (2, ts(1), 3.0, None), (2, ts(1), 3.0, None)], schema)
    more = spark.createDataFrame([(1, ts(1), 0.0, 0.0), (3, ts(2), 1.0, 1.0)], schema)
    path = f"{tmp_path}/table"
    for rows in (batch, batch, more, more):
        io.idempotent_load(spark, rows, path, schema, ["meter_id", "ts"])
    got = sorted(map(tuple, io.scan(spark, path, schema).collect()))
    assert got == [(1, ts(1), None, 9.0), (2, ts(1), 3.0, None), (3, ts(2), 1.0, 1.0)]


def test_a_stored_batch_writes_nothing(spark, tmp_path, monkeypatch):
    schema = type(schemas.MEASUREMENTS)([schemas.MEASUREMENTS["meter_id"], schemas.MEASUREMENTS["ts"], schemas.MEASUREMENTS["energy_kwh"]])
    batch = spark.createDataFrame([(1, dt.datetime(2025, 3, 1), 2.0)], schema)
    path = f"{tmp_path}/table"
    io.idempotent_load(spark, batch, path, schema, ["meter_id", "ts"])
    monkeypatch.setattr(io, "bulk_load", None)  # a write would fail
    io.idempotent_load(spark, batch, path, schema, ["meter_id", "ts"])

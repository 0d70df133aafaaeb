"""Structured Streaming operators over a metering event feed.

The feed is the ``events`` table: each event is a reading of meter ``user_id``
with ``value`` kWh at ``ts``.  ``time_ordered_feed`` first lays a backfill out,
in one write, as files of consecutive time spans that the stream takes in that
order, a bounded number in each micro-batch.  So events are late by no more than
what the source itself declares (``LATENESS``), and that is the watermark: the
state holds the spans of one micro-batch and the lateness, not a share of
history.  State is kept in RocksDB with changelog checkpoints, outside the heap.

Events without a time have no place in event time.  They are written to a side
folder of the feed and are grouped, or told apart, as one group without a time.

Queries run with ``trigger(availableNow=True)``; results go to a Parquet sink
through ``foreachBatch`` (each micro-batch is written by the executors; nothing
is collected).  Feeds, checkpoints and sinks live under the session's shared
checkpoint directory.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calendar as cal
from ..functions.rounding import rnd
from ..sources import io

SPANS = 32  # time spans (files) of a staged feed
FILES_PER_TRIGGER = 8
LATENESS = "1 hour"  # by how much the source may be late

STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


class Feed(NamedTuple):
    """A staged feed: the folder of its files, by how much events may be late
    in it, and the folder of events without a time."""

    path: str
    lateness: str
    undated: str


class Run(NamedTuple):
    """A finished stream: its sink, and the most rows its state has held."""

    sink: str
    state_rows: int


def ntz(t: dt.datetime | None):
    """A wall-clock literal, whatever the session zone."""
    return F.lit(None if t is None else t.isoformat(sep=" ")).cast("timestamp_ntz")


def as_readings(events: DataFrame) -> DataFrame:
    return events.select("event_id", "ts", cal.utc_ntz_to_instant("ts").alias("ets"), F.col("user_id").alias("meter"), "value")


def readings_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    return as_readings(events).drop("ets")


def time_ordered_feed(spark: SparkSession, sf_dir: str, start=None, spans: int = SPANS, lateness: str = LATENESS) -> Feed:
    """Write the events (from ``start`` on, if given) as files of consecutive
    time spans, in one job: range partitioning deals them out, and the files'
    times, by which a file stream orders its input, are set to follow the spans.

    A store that does not keep file times gives its files in any order; there
    the lateness of the feed is the whole extent of its events."""
    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    if start is not None:
        events = events.filter(F.col("ts") >= ntz(start))
    root = io.scratch_path(spark, "feed", sf_dir)
    placed = events.withColumn("dated", F.col("ts").isNotNull()).repartitionByRange(spans, "ts").sortWithinPartitions("dated", "ts")
    placed.write.partitionBy("dated").parquet(root)
    path, undated = f"{root}/dated=true", f"{root}/dated=false"
    if not _in_order_of_names(spark, path):
        first, last = spark.read.schema(EVENTS_SCHEMA).parquet(path).agg(F.min("ts"), F.max("ts")).first()
        lateness = f"{int((last - first).total_seconds()) + 3600} seconds"
    _files(spark, undated)
    return Feed(path, lateness, undated)


def _files(spark: SparkSession, folder: str):
    """(file system, statuses of the data files by name); makes an absent folder."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(jpath)
    found = [f for f in fs.listStatus(jpath) if not f.getPath().getName().startswith(("_", "."))]
    return fs, sorted(found, key=lambda f: f.getPath().getName())


def _in_order_of_names(spark: SparkSession, folder: str) -> bool:
    """Give the files times a second apart, in the order of their names (the
    spans); whether the store has kept them."""
    fs, files = _files(spark, folder)
    last = int(dt.datetime.now().timestamp()) - 1
    for i, f in enumerate(files):
        fs.setTimes(f.getPath(), (last - len(files) + 1 + i) * 1000, -1)
    times = [f.getModificationTime() for f in _files(spark, folder)[1]]
    return all(a < b for a, b in zip(times, times[1:], strict=False))


def undated_readings(spark: SparkSession, feed: Feed) -> DataFrame:
    return as_readings(spark.read.schema(EVENTS_SCHEMA).parquet(feed.undated))


def reading_stream(spark: SparkSession, path: str, max_files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Readings as a stream from a folder whose files arrive in time order:
    event_id, ts (ntz), event time ``ets``, meter, value."""
    return as_readings(spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path))


def _run(stream: DataFrame, spark: SparkSession, name: str, key: str, mode: str) -> Run:
    """Drive the stream to completion into a Parquet sink."""
    root = io.scratch_path(spark, f"stream-{name}", key)
    sink, ckpt = f"{root}/sink", f"{root}/checkpoint"

    def write_batch(df: DataFrame, batch_id: int) -> None:
        # One directory per micro-batch, overwritten on a retry: a batch that is
        # re-run after a failure replaces its own output instead of adding to it.
        df.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():  # a query keeps the settings it was started with
        spark.conf.set(k, v)
    try:
        q = (
            stream.writeStream.outputMode(mode)
            .foreachBatch(write_batch)
            .option("checkpointLocation", ckpt)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    q.awaitTermination()
    if not io.table_exists(spark, sink):  # no micro-batch ran: write an empty batch
        spark.createDataFrame([], stream.schema).write.parquet(f"{sink}/batch_id=0")
    held = [o["numRowsTotal"] for p in q.recentProgress for o in p["stateOperators"]]
    return Run(sink, max(held, default=0))


def hourly_rollup(spark: SparkSession, sf_dir: str, watermark: str | None = None, max_files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Tumbling 1-hour energy per meter with a watermark.

    Update mode emits a window each time it changes; the sink keeps every
    emission with its batch id and the latest emission per window wins.  Events
    without a time are a meter's row without a window.
    """
    feed = time_ordered_feed(spark, sf_dir)
    s = reading_stream(spark, feed.path, max_files_per_trigger).withWatermark("ets", watermark or feed.lateness)
    agg = s.groupBy(F.window("ets", "1 hour").alias("w"), "meter").agg(
        F.sum("value").alias("energy_kwh"), F.count(F.lit(1)).alias("readings")
    )
    out = agg.select("meter", cal.instant_to_utc_ntz("w.start").alias("window_start"), "energy_kwh", "readings")
    res = spark.read.parquet(_run(out, spark, "rollup", sf_dir, "update").sink)
    latest = res.groupBy("meter", "window_start").agg(F.max_by(F.struct("energy_kwh", "readings"), "batch_id").alias("r"))
    rest = undated_readings(spark, feed).groupBy("meter").agg(F.sum("value").alias("energy_kwh"), F.count(F.lit(1)).alias("readings"))
    return latest.select("meter", "window_start", "r.energy_kwh", "r.readings").unionByName(
        rest.select("meter", F.lit(None).cast("timestamp_ntz").alias("window_start"), "energy_kwh", "readings")
    )


def hourly_baseline(readings: DataFrame) -> DataFrame:
    """Mean reading per (meter, hour of day) of past readings."""
    return readings.groupBy("meter", F.hour("ts").alias("hour")).agg(rnd(F.avg("value"), 6).alias("expected"))


def middle_day(readings: DataFrame) -> dt.datetime | None:
    """Midnight of the day half way between the first and the last reading."""
    first, last = readings.agg(F.min("ts"), F.max("ts")).first()
    if first is None:
        return None
    middle = first + (last - first) / 2
    return middle.replace(hour=0, minute=0, second=0, microsecond=0)


def anomaly_stream(spark: SparkSession, sf_dir: str, factor: float = 2.0, max_files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Readings above factor x expected (N2): the baseline is written once from
    the readings before the middle day, the stream holds those from then on.

    The baseline has one row per (meter, hour of day), so it grows with the
    number of meters: no broadcast hint, Spark picks the join by its size.
    """
    readings = readings_batch(spark, sf_dir)
    start = middle_day(readings)
    past = readings.filter(F.col("ts") < ntz(start))
    path = io.scratch_path(spark, "stream-baseline", sf_dir)
    hourly_baseline(past).write.parquet(path)
    base = spark.read.schema("meter long, hour int, expected double").parquet(path)
    feed = time_ordered_feed(spark, sf_dir, start)
    s = reading_stream(spark, feed.path, max_files_per_trigger).withColumn("hour", F.hour("ts"))
    j = s.join(base, ["meter", "hour"]).filter(F.col("value") > F.col("expected") * F.lit(float(factor)))
    out = j.select("event_id", "ts", "meter", "value", "expected")
    return spark.read.parquet(_run(out, spark, "anomaly", sf_dir, "append").sink).drop("batch_id")


def dedup_stream(spark: SparkSession, sf_dir: str, watermark: str | None = None, max_files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Drop re-sent readings: one reading per natural key (meter, ts) (N3); of
    a meter's readings without a time, the first by event id."""
    feed = time_ordered_feed(spark, sf_dir)
    s = reading_stream(spark, feed.path, max_files_per_trigger).withWatermark("ets", watermark or feed.lateness)
    out = s.dropDuplicatesWithinWatermark(["meter", "ets"]).select("event_id", "ts", "meter", "value")
    dated = spark.read.parquet(_run(out, spark, "dedup", sf_dir, "append").sink).drop("batch_id")
    first = undated_readings(spark, feed).groupBy("meter").agg(F.min_by(F.struct("event_id", "ts", "value"), "event_id").alias("r"))
    return dated.unionByName(first.select("r.event_id", "r.ts", "meter", "r.value"))

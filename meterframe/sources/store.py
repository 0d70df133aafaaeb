"""Stored metering tables: ingest once, query many times.

``materialize`` writes the derived metering tables (and the two derived fact
tables, baseline and daily KPIs) as Parquet under a folder of the shared
checkpoint directory; ``StoredTables`` then serves the same attributes as
``MeterTables`` but reads them back with explicit schemas.  Hourly facts are
partitioned by ``year, month`` of ``ts`` and sorted by ``ts`` inside each
file, so time-range predicates skip partitions and row groups.

Reading a written table also cuts the lineage of the derivation: a lost
executor re-reads files instead of recomputing the fixture plans.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import time
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from .buckets import open_site_hours, site_hours, write_site_hours
from .fixtures import MeterTables, main_readings
from .io import table_exists, table_root

HOURLY = {"sub", "measurements", "site_readings", "weather_full", "solar", "battery", "dirty_measurements"}

LAYOUT = "2"  # changes with the columns of the stored tables


def input_version(t: MeterTables) -> str:
    """A folder name that changes with the input's path and files, the time
    zone, the site rule and the stored columns."""
    spark, parts = t.spark, [LAYOUT, t.sf_dir.rstrip("/"), t.tz, str(t.per_site)]
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name in ("lineitem", "supplier"):
        folder = path_of(f"{t.sf_dir.rstrip('/')}/{name}.parquet")
        for f in folder.getFileSystem(conf).listStatus(folder):
            parts.append(f"{f.getPath().getName()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()[:24]


def _write(df: DataFrame, path: str, hourly: bool) -> None:
    if hourly:
        w = df.withColumn("year", F.year("ts")).withColumn("month", F.month("ts")).sortWithinPartitions("year", "month", "ts")
        w.write.mode("overwrite").partitionBy("year", "month").parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def materialize(t: MeterTables, root: str | None = None, overwrite: bool = False, timings: dict | None = None) -> "StoredTables":
    """Write every metering table once; return a reader over the written copy.

    Tables are built in dependency order, each from already-written tables:
    the aggregated raw readings first, then the hourly facts from them, then
    the derived facts (baseline, daily KPIs) from the stored facts.  No plan
    recomputes the line-item derivation twice.
    """
    spark = t.spark
    root = root or table_root(spark, "tables", input_version(t))

    def step(name: str, make) -> None:
        path = f"{root}/{name}"
        if overwrite or not table_exists(spark, f"{path}/_SUCCESS"):
            t0 = time.time()
            _write(make(), path, name in HOURLY)
            if timings is not None:
                timings[name] = round(time.time() - t0, 3)

    def tier(jobs: dict) -> None:
        """Write independent tables as concurrent Spark jobs (one driver thread each)."""
        with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
            for f in [pool.submit(step, name, make) for name, make in jobs.items()]:
                f.result()

    tier({"sub": lambda: t.sub, "dirty_measurements": lambda: t.dirty_measurements, "objects": lambda: t.objects})
    staged = StoredTables(spark, t.sf_dir, root, t.per_site, t.tz)
    staged.sub = staged._read("sub")  # the derivations below start from the stored aggregates
    staged.main = main_readings(staged.sub)
    cols = ["object_id", "slot", "ts", "energy_kwh", "active_power_kw"]
    staged.readings = staged.sub.select(*cols).unionByName(staged.main.select(*cols))
    staged.objects = t.objects
    tier(
        {
            "meters": lambda: MeterTables.meters.func(staged),
            "measurements": staged._derived_measurements,
            "site_readings": lambda: MeterTables.site_readings.func(staged),
            "weather_full": lambda: MeterTables.weather_full.func(staged),
            "solar": lambda: MeterTables.solar.func(staged),
            "battery": lambda: MeterTables.battery.func(staged),
        }
    )
    from ..operators import jobs

    stored = StoredTables(spark, t.sf_dir, root, t.per_site, t.tz)
    tier({"baseline": lambda: jobs.build_baseline(stored, t.tz), "daily_metrics": lambda: jobs.daily_metrics(stored, t.tz)})
    return StoredTables(spark, t.sf_dir, root, t.per_site, t.tz)


class StoredTables(MeterTables):
    """Same attributes as ``MeterTables``, served from the written Parquet copy."""

    def __init__(self, spark: SparkSession, sf_dir: str, root: str, per_site: int, tz: str, span=None):
        super().__init__(spark, sf_dir, per_site, tz)
        self.root = root
        self.span = span  # optional (lo, hi) UTC bounds applied to every hourly fact

    def between(self, start_day: str, end_day: str) -> "StoredTables":
        """The same tables with hourly facts cut to the UTC span that covers the
        closed local-day range [start_day, end_day] (one day of margin before,
        two after, for any UTC offset).

        The cut is stated on the ``year, month`` partition columns as well as on
        ``ts``, so a short report reads only its months' files instead of
        opening every file of the table.
        """
        lo = dt.datetime.fromisoformat(start_day) - dt.timedelta(days=1)
        hi = dt.datetime.fromisoformat(end_day) + dt.timedelta(days=2)
        return StoredTables(self.spark, self.sf_dir, self.root, self.per_site, self.tz, span=(lo, hi))

    def _restrict(self, df: DataFrame) -> DataFrame:
        if self.span is None:
            return df
        lo, hi = self.span
        codes, y, m = [], lo.year, lo.month
        while (y, m) <= (hi.year, hi.month):
            codes.append(y * 100 + m)
            y, m = (y + 1, 1) if m == 12 else (y, m + 1)
        return df.filter(
            (F.col("year") * 100 + F.col("month")).isin(codes)
            & (F.col("ts") >= F.lit(lo.isoformat(sep=" ")).cast("timestamp_ntz"))
            & (F.col("ts") < F.lit(hi.isoformat(sep=" ")).cast("timestamp_ntz"))
        )

    def _read(self, name: str) -> DataFrame:
        """A stored table, read with the schema of its derivation (planned, not run)."""
        schema = getattr(MeterTables, name).func(MeterTables(self.spark, self.sf_dir, self.per_site, self.tz)).schema
        if name not in HOURLY:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        part = T.StructType(list(schema.fields) + [T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())])
        return self._restrict(self.spark.read.schema(part).parquet(f"{self.root}/{name}")).drop("year", "month")

    @cached_property
    def objects(self):
        return self._read("objects")

    @cached_property
    def meters(self):
        return self._read("meters")

    @cached_property
    def measurements(self):
        part = T.StructType(list(schemas.MEASUREMENTS.fields) + [T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())])
        return self._restrict(self.spark.read.schema(part).parquet(f"{self.root}/measurements")).drop("year", "month")

    @cached_property
    def measurements_nocum(self):
        return self.measurements

    def _derived_measurements(self):
        return MeterTables.measurements.func(self)

    @cached_property
    def weather_full(self):
        return self._read("weather_full")

    @cached_property
    def solar(self):
        return self._read("solar")

    @cached_property
    def battery(self):
        return self._read("battery")

    @cached_property
    def site_readings(self):
        return self._read("site_readings")

    @cached_property
    def site_hours(self):
        """The bucketed table, written at first use; a span cuts it by its days.
        The number of buckets is part of its folder's name."""
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        path = f"{self.root}/site_hours_{buckets}"
        if not table_exists(self.spark, f"{path}/_SUCCESS"):
            whole = StoredTables(self.spark, self.sf_dir, self.root, self.per_site, self.tz)
            write_site_hours(site_hours(whole.measurements, whole.meters, whole.solar, whole.battery, self.tz), path, buckets)
        hours = open_site_hours(self.spark, path, buckets)
        if self.span is None:
            return hours
        lo, hi = (F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz") for t in self.span)
        return hours.filter((F.col("day") >= F.lit(self.span[0].date())) & (F.col("day") <= F.lit(self.span[1].date())) & (F.col("ts") >= lo) & (F.col("ts") < hi))

    @cached_property
    def dirty_measurements(self):
        return self._read("dirty_measurements")

    @cached_property
    def baseline(self):
        return self._read("baseline")

    @cached_property
    def daily_metrics(self):
        return self._read("daily_metrics")

    @cached_property
    def main(self):
        """Main-meter hours (object_id, ts, energy, power) from the stored readings."""
        mm = self.meters.filter(F.col("type") == "main").select("meter_id", "object_id")
        return self.measurements.join(mm, "meter_id").select("object_id", "ts", "energy_kwh", "active_power_kw")

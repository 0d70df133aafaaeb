"""Site hours: all hourly facts of a site in one bucketed table.

Zone shares (C2), equipment with its telemetry (C3) and the energy balance (D8)
bring a site's readings, solar and battery rows of the same hour together.  Here
they lie together: one table of readings and telemetry, told apart by ``kind``,
bucketed by (object_id, day) and sorted by day inside a bucket.  Windows and
groupings on a site's hours or days read co-partitioned files and need no
exchange, and a range of days skips row groups by their statistics.

The day is the local day.  A site that holds a third of all rows is dealt out
over as many buckets as it has days.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import calendar as cal

BUCKET = ["object_id", "day"]
SORT = ["day", "object_id", "ts"]
COLUMNS = {
    "object_id": "int", "day": "date", "ts": "timestamp_ntz", "kind": "string", "meter_id": "int", "meter_name": "string", "meter_type": "string",
    "level": "smallint", "location": "string", "active_power_kw": "double", "energy_kwh": "double", "soc_pct": "double", "mode": "string",
}


def site_hours(measurements: DataFrame, meters: DataFrame, solar: DataFrame, battery: DataFrame, tz: str = C.REPORT_TIMEZONE) -> DataFrame:
    """Readings with their meter's names and level (kind ``reading``), and
    telemetry (``solar``, ``battery``) under the type of meter it belongs to."""
    m = meters.select("meter_id", "object_id", F.col("name").alias("meter_name"), F.col("type").alias("meter_type"), "level", "location")
    day = F.to_date(cal.local_ts("ts", tz))
    rows = [
        measurements.join(m, "meter_id").withColumns({"kind": F.lit("reading")}),
        solar.withColumns({"kind": F.lit("solar"), "meter_type": F.lit("solar"), "active_power_kw": F.col("power_kw")}),
        battery.withColumns({"kind": F.lit("battery"), "meter_type": F.lit("battery"), "active_power_kw": F.col("power_kw")}),
    ]
    out = None
    for df in rows:
        df = df.withColumn("day", day)
        df = df.select(*((F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in COLUMNS.items()))
        out = df if out is None else out.unionByName(df)
    return out


def table_name(path: str) -> str:
    return f"meterframe_site_hours_{hashlib.sha1(path.encode()).hexdigest()[:16]}"


def write_site_hours(hours: DataFrame, path: str, buckets: int | None = None) -> DataFrame:
    """Write the table, one file a bucket, and open it."""
    spark = hours.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = hours.select(*COLUMNS).repartition(buckets, *BUCKET)
    dealt.write.bucketBy(buckets, *BUCKET).sortBy(*SORT).option("path", path).mode("errorifexists").saveAsTable(table_name(path))
    return spark.table(table_name(path))


def open_site_hours(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    """The table at ``path``, made known to this session if it is not yet."""
    columns = ", ".join(f"{c} {t}" for c, t in COLUMNS.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table_name(path)} ({columns}) USING parquet "
        f"CLUSTERED BY ({', '.join(BUCKET)}) SORTED BY ({', '.join(SORT)}) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )
    return spark.table(table_name(path))

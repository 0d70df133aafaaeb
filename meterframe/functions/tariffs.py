"""Tariff column functions, the tariff-zone dimension (F5, F6) and zones whose
rates change over time (B13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config as C
from .. import schemas
from .calendar import col, local_ts


def _sec(hms: str) -> int:
    h, m, s = (int(x) for x in hms.split(":"))
    return h * 3600 + m * 60 + s


def tariff_zones(spark: SparkSession) -> DataFrame:
    """The configured zones as a dimension (start/end as seconds of day)."""
    rows = [
        (zid, name, C.TARIFF_NAME, ztype, _sec(start), _sec(end), rate, True, None, None)
        for zid, name, ztype, start, end, rate in C.TARIFF_ZONES
    ]
    return spark.createDataFrame(rows, schemas.TARIFF_ZONES)


def active_tariffs(zones: DataFrame, at=None) -> DataFrame:
    """Zones with ``is_active``; optionally also valid at instant ``at``."""
    out = zones.filter(F.col("is_active"))
    if at is not None:
        t = F.to_timestamp_ntz(F.lit(at))
        out = out.filter(
            (F.col("valid_from").isNull() | (F.col("valid_from") <= t))
            & (F.col("valid_to").isNull() | (F.col("valid_to") > t))
        )
    return out


def tariff_zone(hour) -> Column:
    """day for local hours 7..22, else night.

    Equivalent to the half-open 07:00-23:00 zone on hourly data.
    """
    h = col(hour)
    return F.when(h.between(C.DAY_ZONE_FIRST_HOUR, C.DAY_ZONE_LAST_HOUR), F.lit("day")).otherwise(F.lit("night"))


def tariff_cost(energy, hour, day_rate: float = C.DEFAULT_DAY_RATE, night_rate: float = C.DEFAULT_NIGHT_RATE) -> Column:
    h = col(hour)
    return F.when(
        h.between(C.DAY_ZONE_FIRST_HOUR, C.DAY_ZONE_LAST_HOUR), col(energy) * F.lit(day_rate)
    ).otherwise(col(energy) * F.lit(night_rate))


def zone_hours(zones: DataFrame) -> DataFrame:
    """Expand each zone to the whole hours it covers, honouring midnight wrap.

    Hour h (at h:00:00) is in a zone when ``s <= t < e`` for ``s < e``, or when
    ``t >= s or t < e`` for a wrapping zone.  Each zone yields at most 24 rows,
    so the result is bounded by 24 x number of zones.
    """
    first = F.ceil(F.col("start_sec") / 3600).cast("int")
    stop = F.ceil(F.col("end_sec") / 3600).cast("int")  # first hour not covered
    no_hours = F.array().cast("array<int>")
    straight = F.when(stop > first, F.sequence(first, stop - 1)).otherwise(no_hours)
    wrapped = F.concat(
        F.when(first <= 23, F.sequence(first, F.lit(23))).otherwise(no_hours),
        F.when(stop >= 1, F.sequence(F.lit(0), stop - 1)).otherwise(no_hours),
    )
    hours = F.when(F.col("start_sec") < F.col("end_sec"), straight).otherwise(wrapped)
    return zones.select("zone_id", "zone_type", "rate_uah_kwh", F.explode(hours).alias("hour"))


def hourly_rate_map(zones: DataFrame, default_rate: float = C.DEFAULT_DAY_RATE, default_zone: str = "day") -> DataFrame:
    """24-row map hour -> (zone_type, rate): first matching active zone by id wins."""
    spark = zones.sparkSession
    hours = spark.range(24).select(F.col("id").cast("int").alias("hour"))
    first = (
        zone_hours(active_tariffs(zones))
        .groupBy("hour")
        .agg(F.min_by(F.struct("zone_type", "rate_uah_kwh"), F.col("zone_id")).alias("z"))
    )
    return hours.join(first, "hour", "left").select(
        "hour",
        F.coalesce(F.col("z.zone_type"), F.lit(default_zone)).alias("zone_type"),
        F.coalesce(F.col("z.rate_uah_kwh"), F.lit(default_rate)).alias("rate_uah_kwh"),
    )


def hourly_zone_map(zones: DataFrame) -> DataFrame:
    """Hour -> id of the first active zone covering it (at most 24 rows)."""
    return zone_hours(active_tariffs(zones)).groupBy("hour").agg(F.min("zone_id").alias("zone_id"))


def tariff_usage(readings: DataFrame, zones: DataFrame, hour: str = "hour", energy: str = "energy_kwh") -> DataFrame:
    """Active zones with the readings and kWh billed under each (B13 over the fact).

    Each reading's local hour is mapped to its zone through the 24-row hour
    map (broadcast, a proven bound); the fact is then aggregated per zone.
    """
    hz = hourly_zone_map(zones)
    per_zone = (
        readings.select(F.col(hour).alias("hour"), F.col(energy).alias("_e"))
        .join(F.broadcast(hz), "hour")
        .groupBy("zone_id")
        .agg(F.count(F.lit(1)).alias("readings"), F.sum("_e").alias("kwh"))
    )
    return active_tariffs(zones).join(per_zone, "zone_id", "left").select(
        "zone_id", "name", "zone_type", "start_sec", "end_sec", "rate_uah_kwh",
        F.coalesce("readings", F.lit(0)).alias("readings"), F.coalesce("kwh", F.lit(0.0)).alias("kwh"),
    )


# ---------------------------------------------------------------------------
# Tariffs that change: versions of zones with validity ranges
# ---------------------------------------------------------------------------

DAY_SEC = 86_400


def _month(ts) -> Column:
    """Months since year 0: the cell of a time."""
    return F.year(ts) * 12 + F.month(ts) - 1


def tariff_segments(versions: DataFrame, start: str, end: str, key: list[str] = ()) -> DataFrame:
    """(key..., seg_from, seg_to, slices): what the versions say, without overlaps.

    A version of a zone (zone_id, zone_type, start_sec, end_sec, rate_uah_kwh,
    is_active, valid_from, valid_to) holds for ``valid_from <= t < valid_to``
    (null: unbounded) in the seconds of its day.  The time [start, end) is cut at
    all edges of a key's versions; inside a segment the versions are the same,
    and the day is cut at their zones' edges into slices, each with its winner:
    the smallest zone id, then the latest ``valid_from``, then the smallest
    rate.  A slice that no zone covers has none.  Inactive versions do not count.

    Sizes follow the versions: a key has at most two segments for each, and a
    segment as many slices as its zones have edges.
    """
    keys = list(key)
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in (start, end))
    v = active_tariffs(versions).select(
        *keys, "zone_id", "zone_type", "start_sec", "end_sec", "rate_uah_kwh",
        F.greatest(F.coalesce("valid_from", lo), lo).alias("_from"), F.least(F.coalesce("valid_to", hi), hi).alias("_to"),
        F.coalesce("valid_from", F.lit("0001-01-01").cast("timestamp_ntz")).alias("_since"),
    ).filter("_from < _to")
    edges = v.select(*keys, F.explode(F.array("_from", "_to")).alias("seg_from")).distinct()
    by_time = Window.partitionBy(*keys).orderBy("seg_from") if keys else Window.partitionBy(F.lit(0)).orderBy("seg_from")
    segments = edges.withColumn("seg_to", F.lead("seg_from").over(by_time)).filter(F.col("seg_to").isNotNull())
    named = v.select(*(F.col(k).alias(f"_{k}") for k in keys), "_from", "_to", F.struct(
        "zone_id", (-F.unix_seconds(F.col("_since").cast("timestamp"))).alias("older"), F.col("rate_uah_kwh").alias("rate"), "zone_type", "start_sec", "end_sec"
    ).alias("zone"))
    inside = (F.col("_from") <= F.col("seg_from")) & (F.col("seg_to") <= F.col("_to"))
    for k in keys:
        inside = inside & F.col(k).eqNullSafe(F.col(f"_{k}"))
    zones = segments.join(named, inside).groupBy(*keys, "seg_from", "seg_to").agg(F.array_sort(F.collect_list("zone")).alias("zones"))
    cuts = zones.withColumn("cuts", F.array_sort(F.array_distinct(F.concat(
        F.array(F.lit(0), F.lit(DAY_SEC)), F.transform("zones", lambda z: z.start_sec), F.transform("zones", lambda z: z.end_sec)
    ))))
    covers = lambda z, at: F.when(z.start_sec < z.end_sec, (z.start_sec <= at) & (at < z.end_sec)).otherwise((at >= z.start_sec) | (at < z.end_sec))
    slice_of = lambda at, i: F.struct(
        at.alias("from_sec"), F.get("cuts", i + 1).alias("to_sec"), F.get(F.filter("zones", lambda z: covers(z, at)), F.lit(0)).alias("zone")
    )
    parts = F.filter(F.transform("cuts", slice_of), lambda p: p.to_sec.isNotNull() & p.zone.isNotNull())
    return cuts.select(*keys, "seg_from", "seg_to", F.transform(parts, lambda p: F.struct(
        p.from_sec.alias("from_sec"), p.to_sec.alias("to_sec"), p.zone.zone_id.alias("zone_id"), p.zone.zone_type.alias("zone_type"), p.zone.rate.alias("rate")
    )).alias("slices"))


def asof_tariffs(
    readings: DataFrame, versions: DataFrame, start: str, end: str, key: list[str] = (), tz: str = C.REPORT_TIMEZONE,
    default_rate: float = C.DEFAULT_DAY_RATE, default_zone: str = "day", ts: str = "ts",
) -> DataFrame:
    """Readings with the zone_type and rate_uah_kwh that held at their time, and
    the zone_id (null where no version did: the default holds).  Readings
    outside [start, end), or without a key or a time, are under no version.

    The segments of a key are cut into months, and readings meet them on (key,
    month), an equality join; the exact bound follows in the join.  Segments do
    not overlap, so every reading has one at most and no row is made twice.
    """
    keys = list(key)
    segments = tariff_segments(versions, start, end, keys)
    cells = segments.withColumn("_cell", F.explode(F.sequence(_month("seg_from"), _month(F.col("seg_to") - F.expr("INTERVAL 1 MICROSECOND")))))
    cells = cells.select(*(F.col(k).alias(f"_{k}") for k in keys), "_cell", "seg_from", "seg_to", "slices")
    same = (_month(ts) == F.col("_cell")) & (F.col("seg_from") <= F.col(ts)) & (F.col(ts) < F.col("seg_to"))
    for k in keys:
        same = same & (F.col(k) == F.col(f"_{k}"))
    local = local_ts(ts, tz)
    second = F.hour(local) * 3600 + F.minute(local) * 60 + F.second(local)
    hit = F.get(F.filter("slices", lambda p: (p.from_sec <= F.col("_second")) & (F.col("_second") < p.to_sec)), F.lit(0))
    found = readings.withColumn("_second", second).join(cells, same, "left").withColumn("_hit", hit)
    return found.select(
        *(F.col(f"`{c}`") for c in readings.columns),
        F.col("_hit.zone_id").alias("zone_id"), F.coalesce("_hit.zone_type", F.lit(default_zone)).alias("zone_type"),
        F.coalesce("_hit.rate", F.lit(default_rate)).alias("rate_uah_kwh"),
    )


def asof_bill(billed: DataFrame, key: list[str], tz: str = C.REPORT_TIMEZONE, energy: str = "energy_kwh", ts: str = "ts") -> DataFrame:
    """Per key, local month and zone type: readings, those without a version,
    kWh and cost at the rates of ``asof_tariffs``."""
    local = local_ts(ts, tz)
    return billed.groupBy(*key, F.year(local).alias("year"), F.month(local).alias("month"), "zone_type").agg(
        F.count(F.lit(1)).alias("readings"), F.count_if(F.col("zone_id").isNull()).alias("unversioned"),
        F.sum(energy).alias("total_kwh"), F.sum(F.col(energy) * F.col("rate_uah_kwh")).alias("cost_uah"),
    )

"""Service-level metrics (E1-E11), keyed by site.

The reference computes these per call for one building, often with a query
per reading; here each is one distributed plan over all sites at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import calendar as cal
from ..functions import tariffs as tf
from . import access
from ..functions.rounding import rnd


def hourly_consumption(measurements: DataFrame, meters: DataFrame, start=None, end=None, object_ids=None) -> DataFrame:
    """Main-meter hourly rows per site in the half-open UTC range.

    Sites without a main meter produce no rows.
    """
    mm = access.main_meter(meters, object_ids).select("meter_id", "object_id")
    m = cal.utc_range_filter(measurements, start, end)
    return m.join(mm, "meter_id").select(
        "object_id", "ts", "active_power_kw", "reactive_power_kvar", "energy_kwh", "power_factor"
    )


def daily_sum(measurements: DataFrame, meters: DataFrame, start=None, end=None, meter_ids=None, tz=C.REPORT_TIMEZONE) -> DataFrame:
    """Per meter and local day: kWh, peak, average over a half-open UTC range."""
    m = cal.utc_range_filter(measurements, start, end)
    if meter_ids is not None:
        m = m.filter(F.col("meter_id").isin(list(meter_ids)))
    m = m.join(meters.select("meter_id", "object_id"), "meter_id")
    return m.groupBy("object_id", "meter_id", F.to_date(cal.local_ts("ts", tz)).alias("day")).agg(
        F.sum("energy_kwh").alias("total_kwh"),
        F.max("active_power_kw").alias("peak_kw"),
        F.avg("active_power_kw").alias("avg_kw"),
    )


def monthly_sum(measurements: DataFrame, meters: DataFrame, year: int, meter_ids=None, tz=C.REPORT_TIMEZONE) -> DataFrame:
    """Per meter and local month of a local year: kWh, peak, average, readings."""
    m = measurements
    if meter_ids is not None:
        m = m.filter(F.col("meter_id").isin(list(meter_ids)))
    # UTC pruning bound around the local year, exact local filter on top.
    m = m.filter(
        (F.col("ts") >= F.to_timestamp_ntz(F.lit(f"{year - 1}-12-31")))
        & (F.col("ts") < F.to_timestamp_ntz(F.lit(f"{year + 1}-01-02")))
    )
    lt = cal.local_ts("ts", tz)
    m = m.filter(F.year(lt) == year).join(meters.select("meter_id", "object_id"), "meter_id")
    return m.groupBy("object_id", "meter_id", F.month(lt).alias("month")).agg(
        F.sum("energy_kwh").alias("total_kwh"),
        F.max("active_power_kw").alias("peak_kw"),
        F.avg("active_power_kw").alias("avg_kw"),
        F.count(F.lit(1)).alias("readings"),
    )


def zone_numbers(meters: DataFrame) -> DataFrame:
    """(meter_id, object_id, zone_no): every level-2 meter, numbered within its
    site by meter id from 1."""
    w = Window.partitionBy("object_id").orderBy("meter_id")
    return meters.filter(F.col("level") == 2).select("meter_id", "object_id", F.row_number().over(w).alias("zone_no"))


def zone_consumption_wide(measurements: DataFrame, meters: DataFrame, start=None, end=None) -> DataFrame:
    """All zone meters of a site side by side per hour, outer-aligned on ts.

    Columns z1_, z2_, ... follow the largest number of level-2 meters that any
    site has (one number, read from the meter dimension), so none is dropped.
    A pivot with an explicit value list: one aggregation, no per-zone join.
    Repeated readings of one meter and hour take the larger value.
    """
    z = zone_numbers(meters)
    n = z.agg(F.max("zone_no")).first()[0] or 0
    m = cal.utc_range_filter(measurements, start, end).join(z, "meter_id")
    value = lambda c, i: F.max(F.when(F.col("zone_no") == i, F.col(c))).alias(f"z{i}_{c}")
    columns = [value(c, i) for i in range(1, n + 1) for c in ("energy_kwh", "active_power_kw")]
    hours = m.groupBy("object_id", "ts")
    return hours.agg(*columns) if columns else hours.agg(F.count("*").alias("_n")).drop("_n")


def zone_split(l1: DataFrame, measurements: DataFrame, meters: DataFrame, shares, tz=C.REPORT_TIMEZONE) -> DataFrame:
    """Main consumption allocated to zones by fixed shares, beside what the zone
    meters read, per site and local day (F16).

    ``shares`` lists the share of zone 1, 2, ...; zone 0 is the rest.  Both
    sides are summed to site-days first, so only those rows are multiplied.
    """
    daily = l1.groupBy("object_id", "day").agg(F.sum("energy_kwh").alias("kwh"))
    rest = F.col("kwh")
    for share in shares:
        rest = rest - F.col("kwh") * F.lit(share)
    parts = [F.struct(F.lit(0).alias("zone_no"), rest.alias("allocated_kwh"))]
    parts += [F.struct(F.lit(i).alias("zone_no"), (F.col("kwh") * F.lit(s)).alias("allocated_kwh")) for i, s in enumerate(shares, 1)]
    allocated = daily.select("object_id", "day", F.inline(F.array(*parts)))
    metered = (
        measurements.join(zone_numbers(meters), "meter_id")
        .groupBy("object_id", F.to_date(cal.local_ts("ts", tz)).alias("day"), "zone_no")
        .agg(F.sum("energy_kwh").alias("metered_kwh"))
    )
    return allocated.join(metered, ["object_id", "day", "zone_no"], "left").select("object_id", "day", "zone_no", "allocated_kwh", "metered_kwh")


def rate_by_zone_type(zones: DataFrame) -> DataFrame:
    """First active zone (by id) per zone type with its rate; at most one row per type."""
    return tf.active_tariffs(zones).groupBy("zone_type").agg(F.min_by("rate_uah_kwh", "zone_id").alias("rate"))


def calculate_cost(hourly: DataFrame, objects: DataFrame, zones: DataFrame, tz=C.REPORT_TIMEZONE) -> DataFrame:
    """Day/night kWh and UAH per site, rounded 2; zeros for sites without data (E5).

    Rates come from the active zones (defaults 6.9 / 5.6 when a type is
    missing).  The rate table has one row per zone type, a proven bound, so it
    is broadcast.
    """
    hour = F.hour(cal.local_ts("ts", tz))
    sums = hourly.groupBy("object_id").agg(
        F.sum(F.when(hour.between(C.DAY_ZONE_FIRST_HOUR, C.DAY_ZONE_LAST_HOUR), F.col("energy_kwh")).otherwise(0.0)).alias("day_kwh"),
        F.sum(F.when(~hour.between(C.DAY_ZONE_FIRST_HOUR, C.DAY_ZONE_LAST_HOUR), F.col("energy_kwh")).otherwise(0.0)).alias("night_kwh"),
    )
    rates = rate_by_zone_type(zones)
    r = rates.groupBy().agg(
        F.coalesce(F.max(F.when(F.col("zone_type") == "day", F.col("rate"))), F.lit(C.DEFAULT_DAY_RATE)).alias("day_rate"),
        F.coalesce(F.max(F.when(F.col("zone_type") == "night", F.col("rate"))), F.lit(C.DEFAULT_NIGHT_RATE)).alias("night_rate"),
        F.lit(1).alias("_k"),
    )
    j = (
        objects.select("object_id")
        .join(sums, "object_id", "left")
        .fillna(0.0, subset=["day_kwh", "night_kwh"])
        .withColumn("_k", F.lit(1))
        .join(F.broadcast(r), "_k")
    )
    d, n = F.col("day_kwh"), F.col("night_kwh")
    return j.select(
        "object_id",
        rnd(d, 2).alias("day_kwh"),
        rnd(n, 2).alias("night_kwh"),
        rnd(d * F.col("day_rate"), 2).alias("day_uah"),
        rnd(n * F.col("night_rate"), 2).alias("night_uah"),
        rnd(d * F.col("day_rate") + n * F.col("night_rate"), 2).alias("total_uah"),
    )


def detect_anomalies(hourly: DataFrame, baseline: DataFrame, threshold: float = C.ANOMALY_THRESHOLD_FRACTION, tz=C.REPORT_TIMEZONE) -> DataFrame:
    """Per reading: |actual - expected| / expected > threshold, expected > 0 only.

    One join with the baseline instead of a baseline query per reading.
    """
    lt = cal.local_ts("ts", tz)
    h = hourly.select(
        "object_id", "ts", "energy_kwh", F.month(lt).alias("month"), F.hour(lt).alias("hour_of_day"),
        cal.day_type(lt).alias("day_type"),
    )
    b = baseline.select("object_id", "month", "hour_of_day", "day_type", "expected_kwh").filter(F.col("expected_kwh") > 0)
    j = h.join(b, ["object_id", "month", "hour_of_day", "day_type"])
    dev = F.abs(F.col("energy_kwh") - F.col("expected_kwh")) / F.col("expected_kwh")
    return j.filter(rnd(dev, 6) > F.lit(threshold)).select(
        "object_id", "ts", F.col("energy_kwh").alias("actual_kwh"), "expected_kwh",
        rnd(dev * 100, 1).alias("deviation_pct"),
    )


def specific_consumption_total(daily: DataFrame, objects: DataFrame) -> DataFrame:
    """kWh per m2 per site over the range, round 3; 0 when no data."""
    tot = daily.groupBy("object_id").agg(F.sum("total_kwh").alias("total_kwh"))
    return objects.select("object_id", "area_m2").join(tot, "object_id", "left").select(
        "object_id", rnd(F.coalesce(F.col("total_kwh"), F.lit(0.0)) / F.col("area_m2"), 3).alias("kwh_per_m2")
    )


def solar_summary(solar: DataFrame, start=None, end=None) -> DataFrame:
    """Per site: total kWh (2), peak kW (2), hours with power > 0.1 kW."""
    s = cal.utc_range_filter(solar, start, end)
    return s.groupBy("object_id").agg(
        rnd(F.sum("energy_kwh"), 2).alias("total_generation_kwh"),
        rnd(F.max("power_kw"), 2).alias("peak_power_kw"),
        F.count_if(F.col("power_kw") > C.SOLAR_GENERATING_KW).alias("hours_generating"),
    )


def co2_saved_by_solar(summary: DataFrame, factor: float = C.CO2_KG_PER_KWH) -> DataFrame:
    """Rounded solar total x emission factor, round 2."""
    return summary.select("object_id", rnd(F.col("total_generation_kwh") * F.lit(factor), 2).alias("co2_kg"))


def annual_cost_estimate(annual: DataFrame, zones: DataFrame) -> DataFrame:
    """kWh x (16/24 day rate + 8/24 night rate) with the active rates.

    The last active zone of a type wins, as in the reference loop.
    """
    a = tf.active_tariffs(zones)
    r = a.groupBy().agg(
        F.coalesce(F.max_by(F.when(F.col("zone_type") == "day", F.col("rate_uah_kwh")), F.when(F.col("zone_type") == "day", F.col("zone_id"))), F.lit(C.DEFAULT_DAY_RATE)).alias("day_rate"),
        F.coalesce(F.max_by(F.when(F.col("zone_type") == "night", F.col("rate_uah_kwh")), F.when(F.col("zone_type") == "night", F.col("zone_id"))), F.lit(C.DEFAULT_NIGHT_RATE)).alias("night_rate"),
        F.lit(1).alias("_k"),
    )
    j = annual.withColumn("_k", F.lit(1)).join(F.broadcast(r), "_k")
    est = F.col("annual_kwh") * (F.lit(16 / 24) * F.col("day_rate") + F.lit(8 / 24) * F.col("night_rate"))
    return j.select("object_id", "annual_kwh", rnd(est, 2).alias("estimate_uah"))


def annual_summary(monthly: DataFrame, anomalies: DataFrame, objects: DataFrame) -> DataFrame:
    """Per site: annual kWh, kWh/m2, cost, anomaly count."""
    m = monthly.groupBy("object_id").agg(
        F.sum("total_kwh").alias("total_kwh"), F.sum("total_cost_uah").alias("total_cost_uah")
    )
    a = anomalies.groupBy("object_id").agg(F.count(F.lit(1)).alias("anomalies"))
    return (
        objects.select("object_id", "area_m2")
        .join(m, "object_id", "left")
        .join(a, "object_id", "left")
        .select(
            "object_id",
            F.coalesce("total_kwh", F.lit(0.0)).alias("total_kwh"),
            (F.coalesce("total_kwh", F.lit(0.0)) / F.col("area_m2")).alias("kwh_per_m2"),
            F.coalesce("total_cost_uah", F.lit(0.0)).alias("total_cost_uah"),
            F.coalesce("anomalies", F.lit(0)).alias("anomalies"),
        )
    )

"""The five consumption views (C1-C5) as DataFrame functions.

Each takes the measurement fact and the small meter dimension.  The meter
dimension is joined without a hint: it holds six rows per site, so Spark's
size-based planning (and AQE at run time) broadcasts it while it is small and
falls back to a shuffle join when there are very many sites.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import calendar as cal
from ..functions import physics as ph
from ..functions import tariffs as tf


METER_COLUMNS = {"object_id", "meter_name", "meter_type", "level", "location"}


def _with_meter(measurements: DataFrame, meters: DataFrame, *cond) -> DataFrame:
    """Readings with their meter's columns; those that carry them need no join."""
    if METER_COLUMNS <= set(measurements.columns):
        for c in cond:
            measurements = measurements.filter(c)
        return measurements
    m = meters.select(
        "meter_id", "object_id", F.col("name").alias("meter_name"), F.col("type").alias("meter_type"),
        "level", "location",
    )
    for c in cond:
        m = m.filter(c)
    return measurements.join(m, "meter_id")


def level_1_consumption(
    measurements: DataFrame,
    meters: DataFrame,
    tz: str = C.REPORT_TIMEZONE,
    day_rate: float = C.DEFAULT_DAY_RATE,
    night_rate: float = C.DEFAULT_NIGHT_RATE,
) -> DataFrame:
    """Main (type main, level 1) readings with local calendar, zone and cost.

    Readings that carry object_id, meter_type and level need no join."""
    is_main = (F.col("meter_type") == "main") & (F.col("level") == 1)
    if {"object_id", "meter_type", "level"} <= set(measurements.columns):
        df = measurements.filter(is_main)
    else:
        df = _with_meter(measurements, meters, is_main)
    lt = cal.local_ts("ts", tz)
    return df.select(
        "object_id",
        "ts",
        F.to_date(lt).alias("day"),
        F.month(lt).alias("month"),
        F.year(lt).alias("year"),
        F.hour(lt).alias("hour"),
        cal.day_type(lt).alias("day_type"),
        "active_power_kw",
        "energy_kwh",
        "power_factor",
        tf.tariff_zone(F.hour(lt)).alias("tariff_zone"),
        tf.tariff_cost("energy_kwh", F.hour(lt), day_rate, night_rate).alias("cost_uah"),
    )


def level_2_consumption(measurements: DataFrame, meters: DataFrame, tz: str = C.REPORT_TIMEZONE) -> DataFrame:
    """Zone readings with their share of the main reading at the same hour.

    Instead of a self-join (two shuffles of the fact), level-2 and main rows are
    shuffled once by (object_id, ts) and the main energies are taken with a
    window aggregate over that partition; each partition holds a few rows.  As
    with a join, a site with two main meters gives a row for each, and one
    without a main reading a row with a NULL share.
    """
    df = _with_meter(measurements, meters, (F.col("level") == 2) | (F.col("meter_type") == "main"))
    w = Window.partitionBy("object_id", "ts")
    mains = F.collect_list(F.when(F.col("meter_type") == "main", F.struct(F.col("energy_kwh").alias("_main")))).over(w)
    return (
        df.withColumn("_mains", mains)
        .filter(F.col("level") == 2)
        .select("*", F.inline_outer("_mains"))
        .select(
            "object_id",
            "ts",
            F.to_date(cal.local_ts("ts", tz)).alias("day"),
            "meter_name",
            "meter_type",
            "location",
            "active_power_kw",
            "energy_kwh",
            (ph.safe_ratio("energy_kwh", "_main") * 100.0).alias("share_pct"),
        )
    )


def level_3_consumption(
    measurements: DataFrame, meters: DataFrame, solar: DataFrame, battery: DataFrame, tz: str = C.REPORT_TIMEZONE
) -> DataFrame:
    """Equipment readings, enriched with solar or battery telemetry by type.

    The two conditional left joins become one: solar and battery rows are
    tagged with the meter type they enrich and unioned, then joined once on
    (object_id, ts, meter_type).
    """
    df = _with_meter(measurements, meters, F.col("level") == 3)
    tele = solar.select(
        "object_id", "ts", F.lit("solar").alias("meter_type"),
        F.col("power_kw").alias("solar_power_kw"), F.col("energy_kwh").alias("solar_energy_kwh"),
        F.lit(None).cast("double").alias("battery_soc_pct"), F.lit(None).cast("string").alias("battery_mode"),
    ).unionByName(
        battery.select(
            "object_id", "ts", F.lit("battery").alias("meter_type"),
            F.lit(None).cast("double").alias("solar_power_kw"), F.lit(None).cast("double").alias("solar_energy_kwh"),
            F.col("soc_pct").alias("battery_soc_pct"), F.col("mode").alias("battery_mode"),
        )
    )
    return df.join(tele, ["object_id", "ts", "meter_type"], "left").select(
        "object_id",
        "ts",
        F.to_date(cal.local_ts("ts", tz)).alias("day"),
        "meter_name",
        "meter_type",
        "active_power_kw",
        "energy_kwh",
        "solar_power_kw",
        "solar_energy_kwh",
        "battery_soc_pct",
        "battery_mode",
    )


def level_2_of_hours(hours: DataFrame) -> DataFrame:
    """C2 from site hours (``sources.buckets``): the same rows, without an
    exchange on the bucketed table."""
    df = hours.filter((F.col("kind") == "reading") & ((F.col("level") == 2) | (F.col("meter_type") == "main")))
    hour = Window.partitionBy("object_id", "day", "ts")
    mains = F.collect_list(F.when(F.col("meter_type") == "main", F.struct(F.col("energy_kwh").alias("_main")))).over(hour)
    return df.withColumn("_mains", mains).filter(F.col("level") == 2).select("*", F.inline_outer("_mains")).select(
        "object_id", "ts", "day", "meter_name", "meter_type", "location", "active_power_kw", "energy_kwh",
        (ph.safe_ratio("energy_kwh", "_main") * 100.0).alias("share_pct"),
    )


def level_3_of_hours(hours: DataFrame) -> DataFrame:
    """C3 from site hours: telemetry of the hour is gathered beside its readings
    by a window (a few rows), and a reading has a row for each."""
    equipment = (F.col("kind") == "reading") & (F.col("level") == 3)
    solar, battery = F.col("kind") == "solar", F.col("kind") == "battery"
    told = F.struct(
        F.when(solar, F.col("active_power_kw")).alias("solar_power_kw"), F.when(solar, F.col("energy_kwh")).alias("solar_energy_kwh"),
        F.when(battery, F.col("soc_pct")).alias("battery_soc_pct"), F.when(battery, F.col("mode")).alias("battery_mode"),
    )
    hour = Window.partitionBy("object_id", "day", "ts", "meter_type")
    df = hours.filter(equipment | solar | battery).withColumn("_told", F.collect_list(F.when(solar | battery, told)).over(hour))
    return df.filter(equipment).select(
        "object_id", "ts", "day", "meter_name", "meter_type", "active_power_kw", "energy_kwh", F.inline_outer("_told")
    )


def daily_meter_summary(measurements: DataFrame, meters: DataFrame, tz: str = C.REPORT_TIMEZONE) -> DataFrame:
    """Per (local day, meter): kWh, peak/avg/min kW, reading count (C4)."""
    df = _with_meter(measurements, meters).withColumn("day", F.to_date(cal.local_ts("ts", tz)))
    return df.groupBy("object_id", "day", "meter_id", "meter_name", "meter_type", "level").agg(
        F.sum("energy_kwh").alias("total_kwh"),
        F.max("active_power_kw").alias("peak_kw"),
        F.avg("active_power_kw").alias("avg_kw"),
        F.min("active_power_kw").alias("min_kw"),
        F.count(F.lit(1)).alias("readings_count"),
    )


def monthly_energy_cost(l1: DataFrame) -> DataFrame:
    """Per (local year, month): kWh, day/night kWh, cost, peak/avg kW."""
    return l1.groupBy("object_id", "year", "month").agg(
        F.sum("energy_kwh").alias("total_kwh"),
        F.sum(F.when(F.col("tariff_zone") == "day", F.col("energy_kwh")).otherwise(F.lit(0.0))).alias("day_kwh"),
        F.sum(F.when(F.col("tariff_zone") == "night", F.col("energy_kwh")).otherwise(F.lit(0.0))).alias("night_kwh"),
        F.sum("cost_uah").alias("total_cost_uah"),
        F.max("active_power_kw").alias("peak_kw"),
        F.avg("active_power_kw").alias("avg_kw"),
    )

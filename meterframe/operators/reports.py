"""Data shaping under the report charts (I1-I9).  Drawing is not built.

Inputs are already aggregated report frames (per day, month, zone, hour), so
windows here partition by site over at most a few hundred rows each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import physics as ph
from ..functions.rounding import rnd


def daily_extremes(daily: DataFrame) -> DataFrame:
    """Day of maximum and of minimum daily kWh per site; earliest day on ties."""
    d = F.unix_date("day")
    return daily.groupBy("object_id").agg(
        F.max_by("day", F.struct(F.col("total_kwh"), -d)).alias("max_day"),
        F.max("total_kwh").alias("max_kwh"),
        F.min_by("day", F.struct(F.col("total_kwh"), d)).alias("min_day"),
        F.min("total_kwh").alias("min_kwh"),
    )


def monthly_stack(monthly: DataFrame) -> DataFrame:
    """Month, night, day, total = day + night, cost in thousands."""
    return monthly.select(
        "object_id", "year", "month", "night_kwh", "day_kwh",
        (F.col("day_kwh") + F.col("night_kwh")).alias("total_kwh"),
        (F.col("total_cost_uah") / 1000).alias("cost_k_uah"),
    )


def tariff_shares(zones: DataFrame) -> DataFrame:
    """Zone share of kWh and of UAH in percent per site."""
    w = Window.partitionBy("object_id")
    return zones.select(
        "object_id", "tariff_zone", "total_kwh", "total_uah",
        (F.col("total_kwh") / F.nullif(F.sum("total_kwh").over(w), F.lit(0.0)) * 100).alias("kwh_share_pct"),
        (F.col("total_uah") / F.nullif(F.sum("total_uah").over(w), F.lit(0.0)) * 100).alias("uah_share_pct"),
    )


def specific_bands(specific: DataFrame) -> DataFrame:
    """Monthly kWh/m2 band (high / mid / low), sum and monthly mean of the year (I4)."""
    high, mid = C.SPECIFIC_BAND_LIMITS
    v = F.col("kwh_per_m2")
    w = Window.partitionBy("object_id", "year")
    return specific.select(
        "object_id", "year", "month", "kwh_per_m2",
        F.when(v > high, F.lit("high")).when(v > mid, F.lit("mid")).otherwise(F.lit("low")).alias("band"),
        rnd(F.sum(v).over(w), 9).alias("annual_kwh_per_m2"),
        rnd(F.sum(v).over(w) / 12, 9).alias("monthly_mean_kwh_per_m2"),
        F.lit(C.SPECIFIC_NORMS_KWH_M2_YEAR[0] / 12).alias("norm_low"),
        F.lit(C.SPECIFIC_NORMS_KWH_M2_YEAR[1] / 12).alias("norm_high"),
    )


def profile_peak_hour(profile: DataFrame) -> DataFrame:
    """Hour of the highest average load per (site, day type); lowest hour on ties."""
    return profile.groupBy("object_id", "day_type").agg(
        F.max_by("hour", F.struct(F.col("avg_kw"), -F.col("hour"))).alias("peak_hour"),
        F.max("avg_kw").alias("peak_avg_kw"),
    )


def load_factor_means(lf: DataFrame) -> DataFrame:
    """Mean load factor and mean peak/average over days with a load factor."""
    d = lf.filter(F.col("load_factor").isNotNull())
    return d.groupBy("object_id").agg(
        F.avg("load_factor").alias("mean_load_factor"), F.avg("peak_to_avg").alias("mean_peak_to_avg")
    )


def anomaly_split(anomalies: DataFrame) -> DataFrame:
    """Positive / negative / total anomaly counts and first / last anomaly time."""
    at = F.timestamp_add("HOUR", F.col("hour"), F.col("day").cast("timestamp_ntz"))
    return anomalies.withColumn("at", at).groupBy("object_id").agg(
        F.count_if(F.col("deviation_pct") > 0).alias("positive"),
        F.count_if(F.col("deviation_pct") < 0).alias("negative"),
        F.count(F.lit(1)).alias("total"),
        F.min("at").alias("first_at"),
        F.max("at").alias("last_at"),
    )


def monthly_balance(balance: DataFrame) -> DataFrame:
    """Daily energy balance rolled up to the year and month of the day (I8)."""
    return balance.groupBy("object_id", F.year("day").alias("year"), F.month("day").alias("month")).agg(
        F.sum("consumption_kwh").alias("consumption_kwh"),
        F.sum("solar_kwh").alias("solar_kwh"),
        F.sum("battery_kwh").alias("battery_kwh"),
        F.sum("grid_import_kwh").alias("grid_import_kwh"),
    )


def source_shares(balance: DataFrame) -> DataFrame:
    """Share of solar, battery and grid in their sum of the year, percent."""
    a = balance.groupBy("object_id", F.year("day").alias("year")).agg(
        F.sum("solar_kwh").alias("solar"), F.sum("battery_kwh").alias("battery"), F.sum("grid_import_kwh").alias("grid")
    )
    tot = F.col("solar") + F.col("battery") + F.col("grid")
    return a.select(
        "object_id",
        "year",
        (ph.safe_ratio("solar", tot) * 100).alias("solar_share_pct"),
        (ph.safe_ratio("battery", tot) * 100).alias("battery_share_pct"),
        (ph.safe_ratio("grid", tot) * 100).alias("grid_share_pct"),
    )

"""The analytic report queries (D1-D9), the rolling mean (H1) and the
out-of-sample rolling baseline (N4).

Date filters are on the local day and closed at both ends; each also adds a
redundant UTC bound on ``ts`` so the scan can prune.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import calendar as cal
from ..functions import physics as ph
from ..functions.rounding import rnd


def _in_days(l1: DataFrame, start_date, end_date) -> DataFrame:
    return cal.local_day_filter(l1, start_date, end_date)


def daily_consumption(l1: DataFrame, start_date=None, end_date=None) -> DataFrame:
    """Per local day: kWh, peak, average, cost, day type (D1); level 1 only."""
    return (
        _in_days(l1, start_date, end_date)
        .groupBy("object_id", "day", "day_type")
        .agg(
            F.sum("energy_kwh").alias("total_kwh"),
            F.max("active_power_kw").alias("peak_kw"),
            F.avg("active_power_kw").alias("avg_kw"),
            F.sum("cost_uah").alias("cost_uah"),
        )
        .select("object_id", "day", "total_kwh", "peak_kw", "avg_kw", "cost_uah", "day_type")
    )


def monthly_consumption(monthly: DataFrame, year: int) -> DataFrame:
    """The monthly view for one local year."""
    return monthly.filter(F.col("year") == year)


def tariff_zone_analysis(l1: DataFrame, start_date=None, end_date=None) -> DataFrame:
    """Per tariff zone: kWh, UAH, average kW, hours (D3)."""
    return (
        _in_days(l1, start_date, end_date)
        .groupBy("object_id", "tariff_zone")
        .agg(
            F.sum("energy_kwh").alias("total_kwh"),
            F.sum("cost_uah").alias("total_uah"),
            F.avg("active_power_kw").alias("avg_kw"),
            F.count(F.lit(1)).alias("hours"),
        )
    )


def specific_consumption(l1: DataFrame, objects: DataFrame, start_date=None, end_date=None, area_m2=None) -> DataFrame:
    """Per local (year, month): kWh and kWh per m2.

    The area comes from the site dimension unless ``area_m2`` is given.
    """
    agg = (
        _in_days(l1, start_date, end_date)
        .groupBy("object_id", "year", "month")
        .agg(F.sum("energy_kwh").alias("total_kwh"))
    )
    if area_m2 is not None:
        return agg.select("object_id", "month", "year", "total_kwh", (F.col("total_kwh") / F.lit(float(area_m2))).alias("kwh_per_m2"))
    return agg.join(objects.select("object_id", "area_m2"), "object_id").select(
        "object_id", "month", "year", "total_kwh", (F.col("total_kwh") / F.col("area_m2")).alias("kwh_per_m2")
    )


def baseline_comparison(l1: DataFrame, baseline: DataFrame, start_date=None, end_date=None, object_ids=None) -> DataFrame:
    """Per (local day, hour, day type): actual kWh vs the baseline.

    The readings are summed per key first (a repeated autumn hour gives two
    readings in one group), then joined to the baseline, whose key is unique,
    so the average baseline over the group equals the single matched value.
    """
    df = _in_days(l1, start_date, end_date)
    if object_ids is not None:
        df = df.filter(F.col("object_id").isin(list(object_ids)))
    actual = df.groupBy("object_id", "day", "hour", "day_type").agg(F.sum("energy_kwh").alias("actual_kwh"))
    bl = baseline.select(
        "object_id", "month", F.col("hour_of_day").alias("hour"), "day_type", F.col("expected_kwh").alias("baseline_kwh")
    )
    return (
        actual.withColumn("month", F.month("day"))
        .join(bl, ["object_id", "month", "hour", "day_type"], "left")
        .select(
            "object_id",
            "day",
            "hour",
            "day_type",
            "actual_kwh",
            "baseline_kwh",
            (ph.safe_ratio(F.col("actual_kwh") - F.col("baseline_kwh"), "baseline_kwh") * 100).alias("deviation_pct"),
        )
    )


def anomaly_detection(comparison: DataFrame, threshold_pct: float = C.ANOMALY_THRESHOLD_PCT) -> DataFrame:
    """Rows whose |deviation| exceeds the threshold; NULL deviations drop.

    The deviation is rounded to 6 places before the comparison so that the
    20 % edge does not depend on floating summation order.
    """
    return comparison.filter(F.abs(rnd("deviation_pct", 6)) > F.lit(float(threshold_pct)))


def top_anomalies(anomalies: DataFrame, n: int = 20) -> DataFrame:
    """Per site, the n largest |deviation| (rounded to 1 place); ties by day, hour.

    ``row_number() <= n`` over a site window is planned with a partial
    WindowGroupLimit before the shuffle, so at most n rows per site and map
    task travel; a site with a third of all rows is not a hot spot.
    """
    r = anomalies.select(
        "object_id", "day", "hour", "day_type",
        rnd("actual_kwh", 1).alias("actual_kwh"),
        rnd("baseline_kwh", 1).alias("baseline_kwh"),
        rnd("deviation_pct", 1).alias("deviation_pct"),
    )
    w = Window.partitionBy("object_id").orderBy(F.abs("deviation_pct").desc(), "day", "hour")
    return r.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def load_factor_analysis(l1: DataFrame, start_date=None, end_date=None) -> DataFrame:
    """Per local day: kWh, peak, average, load factor, peak/average."""
    return (
        _in_days(l1, start_date, end_date)
        .groupBy("object_id", "day")
        .agg(
            F.sum("energy_kwh").alias("total_kwh"),
            F.max("active_power_kw").alias("peak_kw"),
            F.avg("active_power_kw").alias("avg_kw"),
        )
        .withColumn("load_factor", ph.safe_ratio("avg_kw", "peak_kw"))
        .withColumn("peak_to_avg", ph.safe_ratio("peak_kw", "avg_kw"))
    )


def solar_battery_balance(l1: DataFrame, solar: DataFrame, battery: DataFrame, start_date=None, end_date=None, tz=C.REPORT_TIMEZONE) -> DataFrame:
    """Per local day: consumption, solar, battery throughput, grid = consumption - solar.

    Hours count only where solar, battery and main readings all exist (the
    inner join on (object_id, ts)).  Instead of two shuffle joins, the three
    inputs are tagged, unioned and dealt out once by (object_id, day), which
    serves the hourly and the daily grouping, and the join is recovered from
    per-hour row counts: a product of n_s solar and n_b battery rows repeats the solar sum
    n_b times, the battery sum n_s times and the (pre-summed) consumption
    n_s * n_b times, so the result equals the join even with duplicate keys.
    """
    tagged = (
        l1.select("object_id", "ts", F.lit(0).alias("_k"), F.col("energy_kwh").alias("_e"))
        .unionByName(solar.select("object_id", "ts", F.lit(1).alias("_k"), F.col("energy_kwh").alias("_e")))
        .unionByName(battery.select("object_id", "ts", F.lit(2).alias("_k"), F.col("energy_kwh").alias("_e")))
    )
    tagged = cal.local_day_filter(tagged.withColumn("day", F.to_date(cal.local_ts("ts", tz))), start_date, end_date)
    return _balance(tagged.repartition("object_id", "day"))


def balance_of_hours(hours: DataFrame, start_date=None, end_date=None) -> DataFrame:
    """D8 from site hours (``sources.buckets``): the same rows, without an
    exchange on the bucketed table."""
    main = (F.col("kind") == "reading") & (F.col("meter_type") == "main") & (F.col("level") == 1)
    kind = F.when(main, 0).when(F.col("kind") == "solar", 1).when(F.col("kind") == "battery", 2)
    tagged = hours.select("object_id", "day", "ts", kind.alias("_k"), F.col("energy_kwh").alias("_e")).filter(F.col("_k").isNotNull())
    for bound, keep in ((start_date, F.col("day") >= F.lit(start_date)), (end_date, F.col("day") <= F.lit(end_date))):
        tagged = tagged.filter(keep) if bound is not None else tagged
    return _balance(tagged)


def _balance(tagged: DataFrame) -> DataFrame:
    """Of (object_id, day, ts, _k: 0 main, 1 solar, 2 battery, _e), dealt out by site and day."""
    k, e = F.col("_k"), F.col("_e")
    hourly = (
        tagged.groupBy("object_id", "day", "ts")
        .agg(
            F.sum(F.when(k == 0, e)).alias("_c"),
            F.sum(F.when(k == 1, e)).alias("_s"),
            F.sum(F.when(k == 2, e)).alias("_b"),
            F.count_if(k == 0).alias("_nc"),
            F.count_if(k == 1).alias("_ns"),
            F.count_if(k == 2).alias("_nb"),
        )
        .filter((F.col("_nc") > 0) & (F.col("_ns") > 0) & (F.col("_nb") > 0))
        .select(
            "object_id",
            "day",
            (F.col("_c") * F.col("_ns") * F.col("_nb")).alias("cons_kwh"),
            (F.col("_s") * F.col("_nb")).alias("solar_kwh"),
            (F.col("_b") * F.col("_ns")).alias("battery_kwh"),
        )
    )
    return hourly.groupBy("object_id", "day").agg(
        F.sum("cons_kwh").alias("consumption_kwh"),
        F.sum("solar_kwh").alias("solar_kwh"),
        F.sum("battery_kwh").alias("battery_kwh"),
        (F.sum("cons_kwh") - F.sum("solar_kwh")).alias("grid_import_kwh"),
    )


def hourly_profile(l1: DataFrame, start_date=None, end_date=None) -> DataFrame:
    """Per (local hour, day type): avg / max / min kW and sample stddev."""
    return (
        _in_days(l1, start_date, end_date)
        .groupBy("object_id", "hour", "day_type")
        .agg(
            F.avg("active_power_kw").alias("avg_kw"),
            F.max("active_power_kw").alias("max_kw"),
            F.min("active_power_kw").alias("min_kw"),
            F.stddev_samp("active_power_kw").alias("std_kw"),
        )
    )


def rolling_7d_mean(daily: DataFrame, value: str = "total_kwh", days: int = 7) -> DataFrame:
    """Mean of the daily value over (day - 7 days, day] per site (H1).

    A RANGE frame on the day number: missing days simply do not contribute,
    as with a time-based pandas rolling window.  Input is one row per site and
    day, so a window partition is bounded by the number of days.
    """
    w = Window.partitionBy("object_id").orderBy(F.unix_date("day")).rangeBetween(-(days - 1), 0)
    return daily.select("object_id", "day", value, F.avg(value).over(w).alias("rolling_mean"))


def rolling_baseline(l1: DataFrame, window_days: int = C.BASELINE_WINDOW_DAYS) -> DataFrame:
    """Out-of-sample baseline: per (site, hour, day type) the mean hourly kWh over
    the previous ``window_days`` days, excluding the day itself (N4)."""
    hourly = l1.groupBy("object_id", "day", "hour", "day_type").agg(F.sum("energy_kwh").alias("actual_kwh"))
    w = (
        Window.partitionBy("object_id", "hour", "day_type")
        .orderBy(F.unix_date("day"))
        .rangeBetween(-window_days, -1)
    )
    return hourly.select(
        "object_id", "day", "hour", "day_type", "actual_kwh",
        F.avg("actual_kwh").over(w).alias("baseline_kwh"),
        F.count("actual_kwh").over(w).alias("baseline_days"),
    )

"""SQL surface (A6) and the yearly report batch (the report runner).

``register_views`` publishes the metering tables and the five consumption
views as temporary views, so the same plans can be queried with
``spark.sql``; ``drop_views`` removes them (views first, then tables -- the
cascade order).  ``run_reports`` computes the yearly report set and writes
each report with distributed writers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import analytics as an
from ..operators import service as sv
from ..operators import views as vw
from ..sources import io

TABLE_VIEWS = {
    "objects": "objects",
    "meters": "meters",
    "measurements": "measurements",
    "weather_data": "weather",
    "tariff_zones": "tariff_zones",
    "solar_generation": "solar",
    "battery_state": "battery",
    "baseline_consumption": "baseline",
    "energy_efficiency_metrics": "daily_metrics",
}
VIEW_NAMES = ["level_1_consumption", "level_2_consumption", "level_3_consumption", "daily_meter_summary", "monthly_energy_cost"]


def consumption_views(t) -> dict[str, DataFrame]:
    l1 = vw.level_1_consumption(t.measurements, t.meters, t.tz)
    return {
        "level_1_consumption": l1,
        "level_2_consumption": vw.level_2_consumption(t.site_readings, t.meters, t.tz),
        "level_3_consumption": vw.level_3_consumption(t.site_readings, t.meters, t.solar, t.battery, t.tz),
        "daily_meter_summary": vw.daily_meter_summary(t.site_readings, t.meters, t.tz),
        "monthly_energy_cost": vw.monthly_energy_cost(l1),
    }


def register_views(t) -> list[str]:
    """Create or replace temp views for the tables and the five views; return their names."""
    names = []
    for view, attr in TABLE_VIEWS.items():
        getattr(t, attr).createOrReplaceTempView(view)
        names.append(view)
    for view, df in consumption_views(t).items():
        df.createOrReplaceTempView(view)
        names.append(view)
    return names


def drop_views(spark: SparkSession) -> None:
    for view in VIEW_NAMES + list(TABLE_VIEWS):
        spark.catalog.dropTempView(view)


def yearly_reports(t, year: int) -> dict[str, DataFrame]:
    """The yearly report set: daily, monthly, tariff zones, specific consumption,
    baseline comparison, anomalies, load factor, hourly profile, energy balance,
    and the annual summary -- one DataFrame each (local days of ``year``)."""
    start, end = f"{year}-01-01", f"{year}-12-31"
    l1 = vw.level_1_consumption(t.site_readings, t.meters, t.tz)
    monthly = an.monthly_consumption(vw.monthly_energy_cost(l1), year)
    comparison = an.baseline_comparison(l1, t.baseline, start, end)
    anomalies = an.anomaly_detection(comparison)
    return {
        "01_daily_consumption": an.daily_consumption(l1, start, end),
        "02_monthly_consumption": monthly,
        "03_tariff_zone_analysis": an.tariff_zone_analysis(l1, start, end),
        "04_specific_consumption": an.specific_consumption(l1, t.objects, start, end),
        "05_baseline_comparison": comparison,
        "06_anomalies": anomalies,
        "07_load_factor": an.load_factor_analysis(l1, start, end),
        "08_hourly_profile": an.hourly_profile(l1, start, end),
        "09_solar_battery_balance": an.solar_battery_balance(l1, t.solar, t.battery, start, end, t.tz),
        "10_annual_summary": sv.annual_summary(monthly, anomalies, t.objects),
    }


# Reports leave in the order of what they have of these.
REPORT_ORDER = ["object_id", "year", "month", "day", "hour", "day_type", "tariff_zone"]


def run_reports(t, out_dir: str, year: int, fmt: str = "csv") -> dict[str, str]:
    """Write every yearly report under ``out_dir``; return name -> path."""
    paths = {}
    for name, df in yearly_reports(t, year).items():
        path = f"{out_dir.rstrip('/')}/{name}"
        order = [c for c in REPORT_ORDER if c in df.columns]
        if fmt == "csv":
            io.report_csv(df, path, order)
        else:
            df.orderBy(*order).write.mode("overwrite").parquet(path)
        paths[name] = path
    return paths

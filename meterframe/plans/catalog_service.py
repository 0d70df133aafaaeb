"""Registered queries for service metrics (E), report shaping (I) and row
access (B)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import access as ac
from ..operators import analytics as an
from ..operators import reports as rp
from ..operators import service as sv
from ..operators import views as vw
from ..sources.io import scratch_path
from ..sources.months import MonthTable
from . import oracle as O
from .catalog import (
    ANOMALY_SQL, BALANCE_SQL, DAILY_SQL, LOAD_FACTOR_SQL, MONTHLY_SQL, PROFILE_SQL,
    SPECIFIC_SQL, balance, comparison, l1, query,
)
from .oracle import END, START, YEAR

UTC_START, UTC_END = "2025-01-01", "2026-01-01"
UTC_RANGE = f"ts >= TIMESTAMP '{UTC_START}' AND ts < TIMESTAMP '{UTC_END}'"
MAIN_METERS = (
    "SELECT * FROM meters WHERE type = 'main' QUALIFY ROW_NUMBER() OVER (PARTITION BY object_id ORDER BY meter_id) = 1"
)
HOURLY_SQL = f"""SELECT mm.object_id, m.ts, m.active_power_kw, m.reactive_power_kvar, m.energy_kwh, m.power_factor
FROM measurements m JOIN ({MAIN_METERS}) mm ON mm.meter_id = m.meter_id WHERE m.{UTC_RANGE}"""


def hourly(t):
    return sv.hourly_consumption(t.measurements_nocum, t.meters, UTC_START, UTC_END)


# ------------------------------------------------------------------ E
@query(
    "hourly_consumption", HOURLY_SQL, ("active_power_kw", "reactive_power_kvar", "energy_kwh", "power_factor")
)
def _e1(t):
    return hourly(t)


@query(
    "daily_sum",
    f"""SELECT mt.object_id, m.meter_id, CAST({O.local('m.ts')} AS DATE) AS day, SUM(m.energy_kwh) AS total_kwh,
           MAX(m.active_power_kw) AS peak_kw, AVG(m.active_power_kw) AS avg_kw
    FROM meas m JOIN meters mt ON mt.meter_id = m.meter_id WHERE m.{UTC_RANGE} GROUP BY ALL""",
    ("total_kwh", "peak_kw", "avg_kw"),
)
def _e2(t):
    return sv.daily_sum(t.measurements_nocum, t.meters, UTC_START, UTC_END)


MONTHLY_SUM_SQL = f"""SELECT mt.object_id, m.meter_id, CAST(month(m.lt) AS INTEGER) AS month, SUM(m.energy_kwh) AS total_kwh,
       MAX(m.active_power_kw) AS peak_kw, AVG(m.active_power_kw) AS avg_kw, COUNT(*) AS readings
FROM (SELECT *, {O.local('ts')} AS lt FROM meas) m JOIN meters mt ON mt.meter_id = m.meter_id
WHERE year(m.lt) = {YEAR} GROUP BY ALL"""


@query("monthly_sum", MONTHLY_SUM_SQL, ("total_kwh", "peak_kw", "avg_kw"))
def _e3(t):
    return sv.monthly_sum(t.measurements_nocum, t.meters, YEAR)


# The fixture's zone meters, by meter id.
ZONE_NAMES = ("Zone HVAC", "Zone lighting", "Zone medical")


def _zone_cols():
    out = []
    for i in (1, 2, 3):
        out.append(f"MAX(CASE WHEN mt.name = '{ZONE_NAMES[i - 1]}' THEN m.energy_kwh END) AS z{i}_energy_kwh")
        out.append(f"MAX(CASE WHEN mt.name = '{ZONE_NAMES[i - 1]}' THEN m.active_power_kw END) AS z{i}_active_power_kw")
    return ", ".join(out)


@query(
    "zone_consumption_wide",
    f"""SELECT mt.object_id, m.ts, {_zone_cols()}
    FROM meas m JOIN meters mt ON mt.meter_id = m.meter_id WHERE mt.level = 2 AND m.{UTC_RANGE}
    GROUP BY mt.object_id, m.ts""",
    tuple(f"z{s}_{c}" for s in (1, 2, 3) for c in ("energy_kwh", "active_power_kw")),
)
def _e4(t):
    return sv.zone_consumption_wide(t.measurements_nocum, t.meters, UTC_START, UTC_END)


COST_SQL = f"""SELECT o.object_id,
       round(coalesce(s.d, 0.0), 2) AS day_kwh, round(coalesce(s.n, 0.0), 2) AS night_kwh,
       round(coalesce(s.d, 0.0) * CAST(6.9 AS DOUBLE), 2) AS day_uah,
       round(coalesce(s.n, 0.0) * CAST(5.6 AS DOUBLE), 2) AS night_uah,
       round(coalesce(s.d, 0.0) * CAST(6.9 AS DOUBLE) + coalesce(s.n, 0.0) * CAST(5.6 AS DOUBLE), 2) AS total_uah
FROM objects o LEFT JOIN (
  SELECT object_id,
         SUM(CASE WHEN hour({O.local('ts')}) BETWEEN 7 AND 22 THEN energy_kwh ELSE 0.0 END) AS d,
         SUM(CASE WHEN NOT hour({O.local('ts')}) BETWEEN 7 AND 22 THEN energy_kwh ELSE 0.0 END) AS n
  FROM ({HOURLY_SQL}) GROUP BY object_id) s ON s.object_id = o.object_id"""


@query("calculate_cost", COST_SQL, ("day_kwh", "night_kwh", "day_uah", "night_uah", "total_uah"))
def _e5(t):
    return sv.calculate_cost(hourly(t), t.objects, t.tariff_zones, t.tz)


@query(
    "detect_anomalies",
    f"""SELECT h.object_id, h.ts, h.energy_kwh AS actual_kwh, b.expected_kwh,
           round(abs(h.energy_kwh - b.expected_kwh) / b.expected_kwh * 100, 1) AS deviation_pct
    FROM (SELECT *, {O.local('ts')} AS lt FROM ({HOURLY_SQL})) h
    JOIN baseline b ON b.object_id = h.object_id AND b.month = month(h.lt) AND b.hour_of_day = hour(h.lt)
         AND b.day_type = CASE WHEN dayofweek(h.lt) IN (0, 6) THEN 'weekend' ELSE 'weekday' END
    WHERE b.expected_kwh > 0 AND round(abs(h.energy_kwh - b.expected_kwh) / b.expected_kwh, 6) > CAST(0.2 AS DOUBLE)""",
    ("actual_kwh", "expected_kwh", "deviation_pct"),
)
def _e6(t):
    return sv.detect_anomalies(hourly(t), t.baseline)


def main_daily(t):
    return sv.daily_sum(t.measurements_nocum, ac.main_meter(t.meters), UTC_START, UTC_END)


@query(
    "specific_consumption_total",
    f"""SELECT o.object_id, round(coalesce(s.tot, 0.0) / o.area_m2, 3) AS kwh_per_m2
    FROM objects o LEFT JOIN (SELECT object_id, SUM(energy_kwh) AS tot FROM ({HOURLY_SQL}) GROUP BY object_id) s
      ON s.object_id = o.object_id""",
    ("kwh_per_m2",),
)
def _e7(t):
    return sv.specific_consumption_total(main_daily(t), t.objects)


SOLAR_SUMMARY_SQL = f"""SELECT object_id, round(SUM(energy_kwh), 2) AS total_generation_kwh, round(MAX(power_kw), 2) AS peak_power_kw,
       COUNT(*) FILTER (WHERE power_kw > 0.1) AS hours_generating
FROM solar WHERE {UTC_RANGE} GROUP BY object_id"""


@query("solar_summary", SOLAR_SUMMARY_SQL, ("total_generation_kwh", "peak_power_kw"))
def _e8(t):
    return sv.solar_summary(t.solar, UTC_START, UTC_END)


@query(
    "co2_saved_by_solar",
    f"SELECT object_id, round(total_generation_kwh * CAST(0.302 AS DOUBLE), 2) AS co2_kg FROM ({SOLAR_SUMMARY_SQL})",
    ("co2_kg",),
)
def _e9(t):
    return sv.co2_saved_by_solar(sv.solar_summary(t.solar, UTC_START, UTC_END))


ANNUAL_SQL = f"""SELECT object_id, SUM(total_kwh) AS annual_kwh FROM ({MONTHLY_SUM_SQL}) s
WHERE meter_id IN (SELECT meter_id FROM ({MAIN_METERS})) GROUP BY object_id"""


def annual(t):
    m = sv.monthly_sum(t.measurements_nocum, ac.main_meter(t.meters), YEAR)
    return m.groupBy("object_id").agg(F.sum("total_kwh").alias("annual_kwh"))


@query(
    "annual_cost_estimate",
    f"""SELECT object_id, annual_kwh,
           round(annual_kwh * (CAST(16 AS DOUBLE) / 24 * CAST(6.9 AS DOUBLE) + CAST(8 AS DOUBLE) / 24 * CAST(5.6 AS DOUBLE)), 2)
             AS estimate_uah
    FROM ({ANNUAL_SQL})""",
    ("annual_kwh", "estimate_uah"),
)
def _e10(t):
    return sv.annual_cost_estimate(annual(t), t.tariff_zones)


@query(
    "annual_summary",
    f"""SELECT o.object_id, coalesce(m.total_kwh, 0.0) AS total_kwh, coalesce(m.total_kwh, 0.0) / o.area_m2 AS kwh_per_m2,
           coalesce(m.total_cost_uah, 0.0) AS total_cost_uah, coalesce(a.anomalies, 0) AS anomalies
    FROM objects o
    LEFT JOIN (SELECT object_id, SUM(total_kwh) AS total_kwh, SUM(total_cost_uah) AS total_cost_uah
               FROM ({MONTHLY_SQL}) WHERE year = {YEAR} GROUP BY object_id) m ON m.object_id = o.object_id
    LEFT JOIN (SELECT object_id, COUNT(*) AS anomalies FROM ({ANOMALY_SQL}) GROUP BY object_id) a ON a.object_id = o.object_id""",
    ("total_kwh", "kwh_per_m2", "total_cost_uah"),
)
def _e11(t):
    monthly = an.monthly_consumption(vw.monthly_energy_cost(l1(t)), YEAR)
    return sv.annual_summary(monthly, an.anomaly_detection(comparison(t)), t.objects)


# ------------------------------------------------------------------ I
@query(
    "daily_extremes",
    f"""SELECT object_id,
           arg_max(day, (total_kwh, -(day - DATE '1970-01-01'))) AS max_day, MAX(total_kwh) AS max_kwh,
           arg_min(day, (total_kwh, day - DATE '1970-01-01')) AS min_day, MIN(total_kwh) AS min_kwh
    FROM ({DAILY_SQL}) GROUP BY object_id""",
    ("max_kwh", "min_kwh"),
)
def _i1(t):
    return rp.daily_extremes(an.daily_consumption(l1(t), START, END))


@query(
    "monthly_stack",
    f"""SELECT object_id, year, month, night_kwh, day_kwh, day_kwh + night_kwh AS total_kwh, total_cost_uah / 1000 AS cost_k_uah
    FROM ({MONTHLY_SQL}) WHERE year = {YEAR}""",
    ("night_kwh", "day_kwh", "total_kwh", "cost_k_uah"),
)
def _i2(t):
    return rp.monthly_stack(an.monthly_consumption(vw.monthly_energy_cost(l1(t)), YEAR))


@query(
    "tariff_shares",
    f"""SELECT object_id, tariff_zone, total_kwh, total_uah,
           total_kwh / NULLIF(SUM(total_kwh) OVER (PARTITION BY object_id), 0) * 100 AS kwh_share_pct,
           total_uah / NULLIF(SUM(total_uah) OVER (PARTITION BY object_id), 0) * 100 AS uah_share_pct
    FROM (SELECT object_id, tariff_zone, SUM(energy_kwh) AS total_kwh, SUM(cost_uah) AS total_uah
          FROM l1 WHERE {O.DAYS} GROUP BY object_id, tariff_zone)""",
    ("total_kwh", "total_uah", "kwh_share_pct", "uah_share_pct"),
)
def _i3(t):
    return rp.tariff_shares(an.tariff_zone_analysis(l1(t), START, END))


@query(
    "specific_bands",
    f"""SELECT object_id, year, month, kwh_per_m2,
           CASE WHEN kwh_per_m2 > CAST(150 AS DOUBLE) / 12 THEN 'high'
                WHEN kwh_per_m2 > CAST(130 AS DOUBLE) / 12 THEN 'mid' ELSE 'low' END AS band,
           round(SUM(kwh_per_m2) OVER (PARTITION BY object_id, year), 9) AS annual_kwh_per_m2,
           round(SUM(kwh_per_m2) OVER (PARTITION BY object_id, year) / 12, 9) AS monthly_mean_kwh_per_m2,
           CAST(150 AS DOUBLE) / 12 AS norm_low, CAST(200 AS DOUBLE) / 12 AS norm_high
    FROM ({SPECIFIC_SQL})""",
    ("kwh_per_m2", "annual_kwh_per_m2", "monthly_mean_kwh_per_m2", "norm_low", "norm_high"),
)
def _i4(t):
    return rp.specific_bands(an.specific_consumption(l1(t), t.objects, START, END))


@query(
    "profile_peak_hour",
    f"""SELECT object_id, day_type, arg_max(hour, (avg_kw, -hour)) AS peak_hour, MAX(avg_kw) AS peak_avg_kw
    FROM ({PROFILE_SQL}) GROUP BY object_id, day_type""",
    ("peak_avg_kw",),
)
def _i5(t):
    return rp.profile_peak_hour(an.hourly_profile(l1(t), START, END))


@query(
    "load_factor_means",
    f"""SELECT object_id, AVG(load_factor) AS mean_load_factor, AVG(peak_to_avg) AS mean_peak_to_avg
    FROM ({LOAD_FACTOR_SQL}) WHERE load_factor IS NOT NULL GROUP BY object_id""",
    ("mean_load_factor", "mean_peak_to_avg"),
)
def _i6(t):
    return rp.load_factor_means(an.load_factor_analysis(l1(t), START, END))


@query(
    "anomaly_split",
    f"""SELECT object_id, COUNT(*) FILTER (WHERE deviation_pct > 0) AS positive,
           COUNT(*) FILTER (WHERE deviation_pct < 0) AS negative, COUNT(*) AS total,
           MIN(CAST(day AS TIMESTAMP) + to_hours(hour)) AS first_at, MAX(CAST(day AS TIMESTAMP) + to_hours(hour)) AS last_at
    FROM ({ANOMALY_SQL}) GROUP BY object_id""",
)
def _i7(t):
    return rp.anomaly_split(an.anomaly_detection(comparison(t)))


@query(
    "monthly_balance",
    f"""SELECT object_id, CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month, SUM(consumption_kwh) AS consumption_kwh,
           SUM(solar_kwh) AS solar_kwh, SUM(battery_kwh) AS battery_kwh, SUM(grid_import_kwh) AS grid_import_kwh
    FROM ({BALANCE_SQL}) GROUP BY object_id, year(day), month(day)""",
    ("consumption_kwh", "solar_kwh", "battery_kwh", "grid_import_kwh"),
)
def _i8(t):
    return rp.monthly_balance(balance(t))


@query(
    "source_shares",
    f"""SELECT object_id, year, solar / NULLIF(solar + battery + grid, 0) * 100 AS solar_share_pct,
           battery / NULLIF(solar + battery + grid, 0) * 100 AS battery_share_pct,
           grid / NULLIF(solar + battery + grid, 0) * 100 AS grid_share_pct
    FROM (SELECT object_id, CAST(year(day) AS INTEGER) AS year, SUM(solar_kwh) AS solar, SUM(battery_kwh) AS battery,
                 SUM(grid_import_kwh) AS grid
          FROM ({BALANCE_SQL}) GROUP BY ALL)""",
    ("solar_share_pct", "battery_share_pct", "grid_share_pct"),
)
def _i9(t):
    return rp.source_shares(balance(t))


# ------------------------------------------------------------------ B
@query(
    "row_count",
    """SELECT 'measurements' AS table_name, COUNT(*) AS rows FROM meas
    UNION ALL SELECT 'weather_data', COUNT(*) FROM weather
    UNION ALL SELECT 'solar_generation', COUNT(*) FROM solar
    UNION ALL SELECT 'battery_state', COUNT(*) FROM battery
    UNION ALL SELECT 'meters', COUNT(*) FROM meters
    UNION ALL SELECT 'objects', COUNT(*) FROM objects""",
)
def _b1(t):
    return ac.row_count(
        {
            "measurements": t.measurements_nocum, "weather_data": t.weather, "solar_generation": t.solar,
            "battery_state": t.battery, "meters": t.meters, "objects": t.objects,
        }
    )


@query(
    "filter_by_eq",
    "SELECT object_id, ts, day, month, year, hour, day_type, active_power_kw, energy_kwh, power_factor, tariff_zone, cost_uah "
    "FROM l1 WHERE day_type = 'weekend' AND tariff_zone = 'night'",
    ("active_power_kw", "energy_kwh", "power_factor", "cost_uah"),
)
def _b3(t):
    return ac.filter_by_eq(l1(t), day_type="weekend", tariff_zone="night")


@query(
    "main_meter",
    f"SELECT meter_id, object_id, name, type, level, location, serial_number, is_active, slot FROM ({MAIN_METERS})",
)
def _b4(t):
    return ac.main_meter(t.meters).select(
        "meter_id", "object_id", "name", "type", "level", "location", "serial_number", "is_active", "slot"
    )


@query(
    "measurement_range",
    f"SELECT {', '.join(ac.MEASUREMENT_PROJECTION)} FROM measurements WHERE {UTC_RANGE}",
    ("active_power_kw", "reactive_power_kvar", "energy_kwh", "power_factor"),
)
def _b5(t):
    return ac.range_scan(t.measurements_nocum, UTC_START, UTC_END, ac.MEASUREMENT_PROJECTION)


@query(
    "weather_range",
    f"SELECT {', '.join(ac.WEATHER_PROJECTION)} FROM weather WHERE {UTC_RANGE}",
    ("temperature_c", "solar_irradiance_wm2", "humidity_pct", "wind_speed_ms", "hdd", "cdd"),
)
def _b6(t):
    return ac.range_scan(t.weather, UTC_START, UTC_END, ac.WEATHER_PROJECTION)


@query(
    "solar_range",
    f"SELECT * FROM solar WHERE {UTC_RANGE}",
    ("power_kw", "energy_kwh", "efficiency_pct", "curtailed_kwh", "irradiance_wm2", "temperature_c", "dc_power_kw"),
)
def _b7(t):
    return ac.range_scan(t.solar, UTC_START, UTC_END)


BATTERY_DOUBLES = ("soc_pct", "soc_kwh", "power_kw", "energy_kwh", "voltage_v", "health_pct", "temperature_c", "cycle_count")


@query("battery_range", f"SELECT * FROM battery_full WHERE {UTC_RANGE}", BATTERY_DOUBLES)
def _b8(t):
    return ac.range_scan(t.battery_full, UTC_START, UTC_END)


@query(
    "metrics_range",
    f"SELECT * FROM metrics WHERE date >= DATE '{START}' AND date < DATE '{UTC_END}'",
    ("total_consumption_kwh", "solar_generation_kwh", "battery_charge_kwh", "battery_discharge_kwh",
     "grid_import_kwh", "grid_export_kwh", "specific_consumption_kwh_m2", "peak_demand_kw", "avg_demand_kw",
     "load_factor", "peak_to_avg_ratio", "self_consumption_ratio", "cost_uah", "cost_day_uah", "cost_night_uah",
     "co2_kg"),
)
def _b9(t):
    return ac.range_scan(t.daily_metrics, START, UTC_END, ts="date")


@query(
    "battery_latest",
    "SELECT * FROM battery_full QUALIFY ROW_NUMBER() OVER (PARTITION BY object_id ORDER BY ts DESC) = 1",
    BATTERY_DOUBLES,
)
def _b10(t):
    return ac.latest(t.battery_full)


LAST_N_SQL = """SELECT mt.object_id, m.meter_id, m.ts, m.energy_kwh,
           CAST(ROW_NUMBER() OVER (PARTITION BY m.meter_id ORDER BY m.ts DESC) AS INTEGER) AS rn
    FROM meas m JOIN meters mt ON mt.meter_id = m.meter_id QUALIFY rn <= 24"""


def _with_site(t, top):
    return top.join(t.meters.select("meter_id", "object_id"), "meter_id").select("object_id", "meter_id", "ts", "energy_kwh", "rn")


@query("last_n_readings", LAST_N_SQL, ("energy_kwh",))
def _b11(t):
    return _with_site(t, ac.last_n(t.measurements_nocum.select("meter_id", "ts", "energy_kwh"), 24))


@query("last_n_newest_first", LAST_N_SQL, ("energy_kwh",))
def _b11n(t):
    """The same from a table stored by month, read from its newest month back."""
    rows = t.measurements_nocum.select("meter_id", "ts", "energy_kwh")
    table = MonthTable(t.spark, scratch_path(t.spark, "newest", t.sf_dir), rows.schema, ["meter_id", "ts"])
    table.create(rows)
    stored = table.read()
    return _with_site(t, ac.newest_first(table.months(), lambda m: table.open([m]), stored.select("meter_id").distinct(), 24) if table.months() else ac.last_n(stored, 24))


@query(
    "baseline_profile",
    "SELECT object_id, month, day_type, hour_of_day, expected_kwh FROM baseline",
    ("expected_kwh",),
)
def _b12(t):
    # Every (site, month, day type) profile; the operator also takes one key.
    return ac.baseline_profile(t.baseline)

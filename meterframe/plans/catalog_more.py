"""Registered queries for scalar functions (F), running totals (G4, G5), the
rolling baseline (N4), data quality (L), sources/sinks (A) and change sets
(B14, B15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from .. import schemas
from ..functions import calendar as cal
from ..functions import physics as ph
from ..functions import tariffs as tf
from ..functions.rounding import rnd
from ..operators import access as ac
from ..operators import analytics as an
from ..operators import jobs
from ..operators import quality as qa
from ..operators import service as sv
from ..sources import io
from ..sources.fixtures import weather_hours
from ..sources.months import MonthTable
from . import oracle as O
from .catalog import DAILY_SQL, l1, query
from .catalog_service import UTC_END, UTC_RANGE, UTC_START

PROFILE_LIST = O._dlist(C.HOURLY_LOAD_PROFILE)
HOLIDAY_CODES = ", ".join(str(m * 100 + d) for m, d in C.HOLIDAYS)
MEAS_DOUBLES = ("active_power_kw", "reactive_power_kvar", "voltage_v", "current_a", "power_factor", "energy_kwh", "cumulative_kwh")


# ------------------------------------------------------------------ F
@query(
    "local_calendar",
    f"""SELECT meter_id, ts, lt AS local_ts, CAST(lt AS DATE) AS day, CAST(month(lt) AS INTEGER) AS month,
           CAST(year(lt) AS INTEGER) AS year, CAST(hour(lt) AS INTEGER) AS hour
    FROM (SELECT meter_id, ts, {O.local('ts')} AS lt FROM meas)""",
)
def _f1(t):
    m = t.measurements_nocum
    return m.select("meter_id", "ts", cal.local_ts("ts", t.tz).alias("local_ts"), *[v.alias(k) for k, v in cal.local_calendar_columns("ts", t.tz).items()])


@query(
    "day_type",
    "SELECT object_id, day, day_type, COUNT(*) AS readings FROM l1 GROUP BY object_id, day, day_type",
)
def _f2(t):
    return l1(t).groupBy("object_id", "day", "day_type").agg(F.count(F.lit(1)).alias("readings"))


DAY_TYPE_HOLIDAY_SQL = f"""CASE WHEN CAST(month(day) AS INTEGER) * 100 + CAST(dayofmonth(day) AS INTEGER) IN ({HOLIDAY_CODES}) THEN 'holiday'
     WHEN dayofweek(day) IN (0, 6) THEN 'weekend' ELSE 'weekday' END"""
DAY_FACTOR_SQL = """CASE dt WHEN 'holiday' THEN CAST(0.65 AS DOUBLE) WHEN 'weekend' THEN CAST(0.72 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END"""


@query(
    "day_type_holiday",
    f"""SELECT object_id, day, dt AS day_type, {DAY_FACTOR_SQL} AS day_factor, readings
    FROM (SELECT object_id, day, {DAY_TYPE_HOLIDAY_SQL} AS dt, COUNT(*) AS readings FROM l1 GROUP BY object_id, day)""",
    ("day_factor",),
)
def _f3(t):
    d = l1(t).groupBy("object_id", "day").agg(F.count(F.lit(1)).alias("readings"))
    dt = cal.day_type_holiday("day")
    return d.select("object_id", "day", dt.alias("day_type"), cal.day_type_factor(dt).alias("day_factor"), "readings")


SEASON_SQL = """CASE WHEN month IN (12, 1, 2) THEN 'winter' WHEN month IN (3, 4, 5) THEN 'spring'
     WHEN month IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END"""
SEASON_FACTOR_SQL = """CASE season WHEN 'winter' THEN CAST(1.18 AS DOUBLE) WHEN 'spring' THEN CAST(0.95 AS DOUBLE)
     WHEN 'summer' THEN CAST(1.08 AS DOUBLE) ELSE CAST(0.92 AS DOUBLE) END"""


@query(
    "season",
    f"""SELECT object_id, year, month, season, {SEASON_FACTOR_SQL} AS season_factor, total_kwh
    FROM (SELECT object_id, year, month, {SEASON_SQL} AS season, SUM(energy_kwh) AS total_kwh FROM l1 GROUP BY object_id, year, month)""",
    ("season_factor", "total_kwh"),
)
def _f4(t):
    m = l1(t).groupBy("object_id", "year", "month").agg(F.sum("energy_kwh").alias("total_kwh"))
    s = cal.season("month")
    return m.select("object_id", "year", "month", s.alias("season"), cal.season_factor(s).alias("season_factor"), "total_kwh")


@query(
    "tariff_zone_cost",
    f"""SELECT meter_id, ts, CAST(hour(lt) AS INTEGER) AS hour,
           CASE WHEN hour(lt) BETWEEN 7 AND 22 THEN 'day' ELSE 'night' END AS tariff_zone,
           CASE WHEN hour(lt) BETWEEN 7 AND 22 THEN energy_kwh * CAST(6.9 AS DOUBLE) ELSE energy_kwh * CAST(5.6 AS DOUBLE) END AS cost_uah
    FROM (SELECT meter_id, ts, energy_kwh, {O.local('ts')} AS lt FROM meas)""",
    ("cost_uah",),
)
def _f5(t):
    h = F.hour(cal.local_ts("ts", t.tz))
    return t.measurements_nocum.select(
        "meter_id", "ts", h.alias("hour"), tf.tariff_zone(h).alias("tariff_zone"), tf.tariff_cost("energy_kwh", h).alias("cost_uah")
    )


@query(
    "tariff_rate_lookup",
    """SELECT object_id, ts, hour,
           CASE WHEN hour * 3600 >= 25200 AND hour * 3600 < 82800 THEN 'day' ELSE 'night' END AS zone_type,
           CASE WHEN hour * 3600 >= 25200 AND hour * 3600 < 82800 THEN CAST(6.9 AS DOUBLE) ELSE CAST(5.6 AS DOUBLE) END AS rate_uah_kwh
    FROM l1""",
    ("rate_uah_kwh",),
)
def _f6(t):
    # The hour -> rate map has at most 24 rows: a proven bound, so broadcast.
    rates = tf.hourly_rate_map(t.tariff_zones)
    return l1(t).select("object_id", "ts", "hour").join(F.broadcast(rates), "hour").select(
        "object_id", "ts", "hour", "zone_type", "rate_uah_kwh"
    )


@query(
    "tariff_asof_cost",
    f"""SELECT object_id, CAST(year(lt) AS INTEGER) AS year, CAST(month(lt) AS INTEGER) AS month, coalesce(zone_type, 'day') AS zone_type,
           COUNT(*) AS readings, COUNT(*) FILTER (zone_id IS NULL) AS unversioned, SUM(energy_kwh) AS total_kwh,
           SUM(energy_kwh * coalesce(rate_uah_kwh, 6.9::DOUBLE)) AS cost_uah
    FROM (SELECT r.*, v.zone_id, v.zone_type, v.rate_uah_kwh
          FROM (SELECT object_id, ts, energy_kwh, {O.local('ts')} AS lt FROM l1) r
          LEFT JOIN tariff_versions v ON v.object_id = r.object_id AND v.is_active
              AND r.ts BETWEEN coalesce(v.valid_from, TIMESTAMP '1900-01-01') AND coalesce(v.valid_to - INTERVAL 1 MICROSECOND, TIMESTAMP '2200-01-01')
              AND (CASE WHEN start_sec < end_sec THEN hour(lt) * 3600 BETWEEN start_sec AND end_sec - 1
                        ELSE hour(lt) * 3600 >= start_sec OR hour(lt) * 3600 < end_sec END)
          QUALIFY ROW_NUMBER() OVER (PARTITION BY r.object_id, r.ts ORDER BY zone_id, v.valid_from DESC NULLS LAST, rate_uah_kwh) = 1)
    GROUP BY ALL""",
    ("total_kwh", "cost_uah"),
)
def _b13v(t):
    """Bills of the main readings under each site's versions of its tariff."""
    billed = tf.asof_tariffs(l1(t).select("object_id", "ts", "energy_kwh"), t.tariff_versions, "2025-01-01", "2026-01-01", ["object_id"], t.tz)
    return tf.asof_bill(billed, ["object_id"], t.tz)


@query(
    "active_tariffs",
    """SELECT t.zone_id, t.name, t.zone_type, t.start_sec, t.end_sec, t.rate_uah_kwh,
           coalesce(u.readings, 0) AS readings, coalesce(u.kwh, 0.0) AS kwh
    FROM tariffs t LEFT JOIN (
      SELECT CASE WHEN hour * 3600 >= 25200 AND hour * 3600 < 82800 THEN 1 ELSE 2 END AS zone_id,
             COUNT(*) AS readings, SUM(energy_kwh) AS kwh
      FROM l1 GROUP BY 1) u ON u.zone_id = t.zone_id
    WHERE t.is_active""",
    ("rate_uah_kwh", "kwh"),
)
def _b13(t):
    return tf.tariff_usage(l1(t), t.tariff_zones)


@query(
    "degree_days",
    f"""SELECT object_id, CAST({O.local('ts')} AS DATE) AS day, SUM(hdd) AS hdd, SUM(cdd) AS cdd
    FROM weather GROUP BY ALL""",
    ("hdd", "cdd"),
)
def _f7(t):
    w = t.weather
    return w.groupBy("object_id", F.to_date(cal.local_ts("ts", t.tz)).alias("day")).agg(
        F.sum("hdd").alias("hdd"), F.sum("cdd").alias("cdd")
    )


TEMP_ADJ_SQL = """CASE WHEN temperature_c < 15.0 THEN (15.0 - temperature_c) * CAST(0.35 AS DOUBLE)
     WHEN temperature_c > 22.0 THEN (temperature_c - 22.0) * CAST(0.28 AS DOUBLE) ELSE 0.0 END"""


@query(
    "temperature_adjustment",
    f"SELECT object_id, ts, temperature_c, {TEMP_ADJ_SQL} AS temp_adj_kw FROM weather",
    ("temperature_c", "temp_adj_kw"),
)
def _f8(t):
    return t.weather.select("object_id", "ts", "temperature_c", ph.temperature_adjustment("temperature_c").alias("temp_adj_kw"))


@query(
    "expected_load",
    f"""SELECT object_id, ts, expected_kw, active_power_kw - expected_kw AS residual_kw FROM (
      SELECT x.object_id, x.ts, x.active_power_kw,
             round(least(greatest(CAST(22.0 AS DOUBLE) * ({PROFILE_LIST})[x.hour + 1]
                   * (CASE WHEN CAST(month(x.day) AS INTEGER) * 100 + CAST(dayofmonth(x.day) AS INTEGER) IN ({HOLIDAY_CODES}) THEN CAST(0.65 AS DOUBLE)
                           WHEN x.day_type = 'weekend' THEN CAST(0.72 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END)
                   * (CASE WHEN x.month IN (12, 1, 2) THEN CAST(1.18 AS DOUBLE) WHEN x.month IN (3, 4, 5) THEN CAST(0.95 AS DOUBLE)
                           WHEN x.month IN (6, 7, 8) THEN CAST(1.08 AS DOUBLE) ELSE CAST(0.92 AS DOUBLE) END)
                   + (CASE WHEN w.temperature_c < 15.0 THEN (15.0 - w.temperature_c) * CAST(0.35 AS DOUBLE)
                           WHEN w.temperature_c > 22.0 THEN (w.temperature_c - 22.0) * CAST(0.28 AS DOUBLE) ELSE 0.0 END),
                   CAST(5.0 AS DOUBLE)), CAST(38.0 AS DOUBLE)), 3) AS expected_kw
      FROM l1 x JOIN weather w ON w.object_id = x.object_id AND w.ts = x.ts)""",
    ("expected_kw", "residual_kw"),
)
def _f9(t):
    x = jobs.with_hourly(l1(t), t.weather, "temperature_c")
    dt = cal.day_type_holiday("day")
    exp = ph.expected_load("hour", cal.day_type_factor(dt), cal.season_factor(cal.season("month")), "temperature_c")
    return x.select("object_id", "ts", exp.alias("expected_kw"), "active_power_kw").select(
        "object_id", "ts", "expected_kw", (F.col("active_power_kw") - F.col("expected_kw")).alias("residual_kw")
    )


@query(
    "expected_solar",
    """SELECT object_id, ts, round(dc, 3) AS dc_power_kw, round(ac, 3) AS ac_power_kw, round(ac / 35.0 * 100.0, 2) AS efficiency_pct,
           power_kw / NULLIF(ac, 0) AS performance_ratio
    FROM (SELECT s.object_id, s.ts, s.power_kw, dc, least(greatest(dc * CAST(0.97 AS DOUBLE), 0.0), 35.0) AS ac
          FROM (SELECT s.*, w.solar_irradiance_wm2 / 1000.0 * 35.0 * (1.0 - greatest(0.0, (w.temperature_c - 25.0) * CAST(0.004 AS DOUBLE))) AS dc
                FROM solar s JOIN weather w ON w.object_id = s.object_id AND w.ts = s.ts) s)""",
    ("dc_power_kw", "ac_power_kw", "efficiency_pct", "performance_ratio"),
)
def _f10(t):
    j = jobs.with_hourly(t.solar.drop("temperature_c"), t.weather, "solar_irradiance_wm2", "temperature_c")
    j = j.withColumn("dc", ph.solar_dc_kw("solar_irradiance_wm2", "temperature_c")).withColumn("ac", ph.solar_ac_kw("dc"))
    return j.select(
        "object_id", "ts", rnd("dc", 3).alias("dc_power_kw"), rnd("ac", 3).alias("ac_power_kw"),
        rnd(ph.solar_efficiency_pct("ac"), 2).alias("efficiency_pct"), ph.safe_ratio("power_kw", "ac").alias("performance_ratio"),
    )


def _fill_base(t):
    lt = cal.local_ts("ts", t.tz)
    return weather_hours(t.weather_sites).select("object_id", "ts", F.month(lt).alias("m"), F.dayofyear(lt).alias("doy"), F.hour(lt).alias("h"))


@query(
    "temperature_climatology",
    f"""SELECT b.object_id, b.ts,
           coalesce(w.temperature_c, round(({O._dlist(C.MONTHLY_AVG_TEMP_C)})[b.m] + 1.5 * sin((b.doy - 15) * 2 * pi() / 365)
                    + 4.0 * cos((b.h - 14) * pi() / 12), 2)) AS temperature_c,
           w.temperature_c IS NULL AS filled
    FROM wbase b LEFT JOIN weather_gappy w ON w.object_id = b.object_id AND w.ts = b.ts""",
    ("temperature_c",),
)
def _f11(t):
    b = jobs.with_hourly(_fill_base(t), t.weather_gappy, "temperature_c", how="left")
    clim = rnd(ph.temperature_climatology("m", "doy", "h"), 2)
    return b.select("object_id", "ts", F.coalesce("temperature_c", clim).alias("temperature_c"), F.col("temperature_c").isNull().alias("filled"))


@query(
    "irradiance_climatology",
    f"""SELECT b.object_id, b.ts,
           coalesce(w.solar_irradiance_wm2, round(CASE WHEN abs(b.h - 12.5) >= 5.5 + 1.5 * sin((b.m - 6) * pi() / 6) THEN 0.0
             ELSE greatest(0.0, ({O._dlist(C.MONTHLY_PEAK_IRRADIANCE_WM2)})[b.m]
                  * greatest(0.0, cos((b.h - 12.5) * pi() / ((5.5 + 1.5 * sin((b.m - 6) * pi() / 6)) * 2)))
                  * (1.0 - 0.75 * ((57.5 - 17.5 * cos((b.m - 7) * pi() / 6)) / 100.0))) END, 2)) AS solar_irradiance_wm2,
           w.solar_irradiance_wm2 IS NULL AS filled
    FROM wbase b LEFT JOIN weather_gappy w ON w.object_id = b.object_id AND w.ts = b.ts""",
    ("solar_irradiance_wm2",),
)
def _f12(t):
    b = jobs.with_hourly(_fill_base(t), t.weather_gappy, "solar_irradiance_wm2", how="left")
    clim = rnd(ph.irradiance_climatology("m", "h", ph.cloud_climatology("m")), 2)
    return b.select(
        "object_id", "ts", F.coalesce("solar_irradiance_wm2", clim).alias("solar_irradiance_wm2"),
        F.col("solar_irradiance_wm2").isNull().alias("filled"),
    )


@query(
    "electrical_derivations",
    """SELECT meter_id, ts, active_power_kw, power_factor,
           CASE WHEN active_power_kw > 0 THEN round(active_power_kw * 1000.0 / (voltage_v * power_factor * sqrt(3.0)), 2) ELSE 0.0 END AS current_a,
           CASE WHEN power_factor BETWEEN 0 AND 1 THEN round(active_power_kw * tan(acos(power_factor)), 3) END AS reactive_power_kvar
    FROM dirty""",
    ("active_power_kw", "power_factor", "current_a", "reactive_power_kvar"),
)
def _f13(t):
    d = t.dirty_measurements
    return d.select(
        "meter_id", "ts", "active_power_kw", "power_factor",
        ph.current_a("active_power_kw", "voltage_v", "power_factor").alias("current_a"),
        ph.reactive_kvar("active_power_kw", "power_factor").alias("reactive_power_kvar"),
    )


@query(
    "battery_derivations",
    """SELECT object_id, ts, soc_kwh / 25.0 * 100.0 AS soc_pct, round(48.0 + (soc_kwh / 25.0 * 100.0 - 50) * 0.1, 2) AS voltage_v,
           abs(power_kw) AS energy_kwh
    FROM battery""",
    ("soc_pct", "voltage_v", "energy_kwh"),
)
def _f14(t):
    b = t.battery
    soc = ph.battery_soc_pct("soc_kwh")
    return b.select("object_id", "ts", soc.alias("soc_pct"), ph.battery_voltage(soc).alias("voltage_v"), F.abs("power_kw").alias("energy_kwh"))


@query(
    "safe_ratio",
    f"""SELECT object_id, day, zone_kwh, main_kwh, zone_kwh / NULLIF(main_kwh, 0) * 100 AS zone_share_pct FROM (
      SELECT mt.object_id, CAST({O.local('m.ts')} AS DATE) AS day,
             SUM(CASE WHEN mt.level = 2 THEN m.energy_kwh ELSE 0.0 END) AS zone_kwh,
             SUM(CASE WHEN mt.type = 'main' THEN m.energy_kwh ELSE 0.0 END) AS main_kwh
      FROM meas m JOIN meters mt ON mt.meter_id = m.meter_id GROUP BY ALL)""",
    ("zone_kwh", "main_kwh", "zone_share_pct"),
)
def _f15(t):
    m = t.measurements_nocum.join(t.meters.select("meter_id", "object_id", "type", "level"), "meter_id")
    d = m.groupBy("object_id", F.to_date(cal.local_ts("ts", t.tz)).alias("day")).agg(
        F.sum(F.when(F.col("level") == 2, F.col("energy_kwh")).otherwise(F.lit(0.0))).alias("zone_kwh"),
        F.sum(F.when(F.col("type") == "main", F.col("energy_kwh")).otherwise(F.lit(0.0))).alias("main_kwh"),
    )
    return d.withColumn("zone_share_pct", ph.safe_ratio("zone_kwh", "main_kwh") * 100)


@query(
    "zone_split",
    f"""WITH alloc AS (
      SELECT object_id, day, s.zone_no, SUM(energy_kwh) * any_value(s.share) AS allocated_kwh
      FROM l1 CROSS JOIN (VALUES (1, CAST(0.30 AS DOUBLE)), (2, CAST(0.18 AS DOUBLE)), (3, CAST(0.32 AS DOUBLE))) s(zone_no, share)
      GROUP BY object_id, day, s.zone_no
      UNION ALL
      SELECT object_id, day, 0, SUM(energy_kwh) - SUM(energy_kwh) * CAST(0.30 AS DOUBLE) - SUM(energy_kwh) * CAST(0.18 AS DOUBLE)
             - SUM(energy_kwh) * CAST(0.32 AS DOUBLE)
      FROM l1 GROUP BY object_id, day),
    metered AS (
      SELECT mt.object_id, CAST({O.local('m.ts')} AS DATE) AS day, mt.slot - 1 AS zone_no, SUM(m.energy_kwh) AS metered_kwh
      FROM meas m JOIN meters mt ON mt.meter_id = m.meter_id WHERE mt.level = 2 GROUP BY ALL)
    SELECT a.object_id, a.day, CAST(a.zone_no AS INTEGER) AS zone_no, a.allocated_kwh, mt.metered_kwh
    FROM alloc a LEFT JOIN metered mt ON mt.object_id = a.object_id AND mt.day = a.day AND mt.zone_no = a.zone_no""",
    ("allocated_kwh", "metered_kwh"),
)
def _f16(t):
    return sv.zone_split(l1(t), t.measurements_nocum, t.meters, [share for _, share in C.ZONE_SHARES], t.tz)


# ------------------------------------------------------------------ G4, G5, N4
BATTERY_CYCLES_SQL = """SELECT object_id, ts, mode,
           round(SUM(CASE WHEN mode = 'discharging' THEN abs(power_kw) / 25.0 ELSE 0.0 END)
                 OVER (PARTITION BY object_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS cycle_count
    FROM battery"""


@query("battery_cycles", BATTERY_CYCLES_SQL, ("cycle_count",))
def _g4(t):
    return jobs.battery_cycles(t.battery)


@query("cycles_resumed", BATTERY_CYCLES_SQL, ("cycle_count",))
def _g4r(t):
    """Three loads: each goes on from the stored month totals of those before."""
    return _in_loads(t, t.battery.select("object_id", "ts", "mode", "power_kw"), jobs.discharged(), "object_id", jobs.resumed_cycles)


@query(
    "totalizer_resumed",
    "SELECT meter_id, ts, energy_kwh, cumulative_kwh FROM measurements",
    ("energy_kwh", "cumulative_kwh"),
)
def _g3r(t):
    """As above, for the meters' totals."""
    return _in_loads(t, t.measurements_nocum.select("meter_id", "ts", "energy_kwh"), "energy_kwh", "meter_id", jobs.resumed_totalizer)


def _in_loads(t, rows, value, key, resume):
    """rows loaded in three parts, split inside months; the totals of each load
    are written, and only they are read by the next."""
    path = io.scratch_path(t.spark, "load-totals", t.sf_dir)
    day = F.dayofyear("ts")
    out = None
    for n, (first, last) in enumerate(((0, 100), (100, 232), (232, 400))):
        load = rows.filter((day > first) & (day <= last))
        earlier = t.spark.read.parquet(*(f"{path}/{i}" for i in range(n))) if n else jobs.chunk_totals(rows.limit(0), value, key)
        summed = resume(load, earlier)
        jobs.chunk_totals(load, value, key).write.parquet(f"{path}/{n}")
        out = summed if out is None else out.unionByName(summed)
    return out


@query("baseline_merge", "SELECT * FROM baseline", ("expected_kwh", "std_dev_kwh", "temperature_coeff"))
def _g1m(t):
    """The baseline from the stored moments of three loads of days.

    The main readings are derived once, stored by load; each load meets the
    weather of its own days."""
    path = io.scratch_path(t.spark, "baseline-states", t.sf_dir)
    load = lambda day: F.dayofyear(day) % 3
    main = l1(t).select("object_id", "ts", "month", "hour", "day_type", "energy_kwh", load("day").alias("load"))
    main.write.partitionBy("load").parquet(f"{path}/main")
    weather_load = load(F.to_date(cal.local_ts("ts", t.tz)))
    for n in range(3):
        rows = t.spark.read.schema(main.schema).parquet(f"{path}/main").filter(F.col("load") == n)
        jobs.baseline_states(rows, t.weather.filter(weather_load == n)).write.parquet(f"{path}/{n}")
    return jobs.baseline_of(t.spark.read.parquet(*(f"{path}/{n}" for n in range(3))))


@query(
    "energy_from_power",
    "SELECT meter_id, ts, active_power_kw, active_power_kw * 1.0 AS energy_from_power_kwh FROM meas",
    ("active_power_kw", "energy_from_power_kwh"),
)
def _g5(t):
    return jobs.energy_from_power(t.measurements_nocum)


@query(
    "rolling_baseline_30d",
    """SELECT object_id, day, hour, day_type, actual_kwh,
           AVG(actual_kwh) OVER w AS baseline_kwh, COUNT(actual_kwh) OVER w AS baseline_days
    FROM (SELECT object_id, day, hour, day_type, SUM(energy_kwh) AS actual_kwh FROM l1 GROUP BY ALL)
    WINDOW w AS (PARTITION BY object_id, hour, day_type ORDER BY day
                 RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING)""",
    ("actual_kwh", "baseline_kwh"),
)
def _n4(t):
    return an.rolling_baseline(l1(t), C.BASELINE_WINDOW_DAYS)


# ------------------------------------------------------------------ L
def quality_tables(t):
    return {
        "objects": t.objects,
        "meters": t.meters,
        "measurements": t.dirty_measurements,
        "weather_data": t.weather,
        "tariff_zones": t.tariff_zones,
        "baseline_consumption": t.baseline,
        "solar_generation": t.solar,
        "battery_state": t.battery,
        "energy_efficiency_metrics": t.daily_metrics,
    }


def _sql_counts(table: str, src: str, rules: list[tuple[str, str]], kind: str = "rule") -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS {kind}, COUNT(*) FILTER (WHERE NOT coalesce({cond}, TRUE)) AS violations FROM {src}"
        for name, cond in rules
    )


CHECK_SQL = " UNION ALL ".join(
    [
        _sql_counts("objects", "(SELECT *, 5.0 AS min_load_kw, 22.0 AS avg_load_kw, 38.0 AS max_load_kw FROM objects)", [
            ("ck_min_le_avg", "min_load_kw <= avg_load_kw"), ("ck_avg_le_max", "avg_load_kw <= max_load_kw"),
            ("ck_area_positive", "area_m2 > 0")]),
        _sql_counts("meters", "meters", [("ck_meter_level", "level IN (1, 2, 3)")]),
        _sql_counts("measurements", "dirty", [
            ("ck_power_non_negative", "active_power_kw >= 0"), ("ck_pf_range", "power_factor BETWEEN 0 AND 1"),
            ("ck_quality_flag", "quality_flag IN (-1, 0, 1)")]),
        _sql_counts("weather_data", "weather", [
            ("ck_humidity", "humidity_pct BETWEEN 0 AND 100"), ("ck_cloud_cover", "cloud_cover_pct BETWEEN 0 AND 100"),
            ("ck_irradiance", "solar_irradiance_wm2 >= 0")]),
        _sql_counts("tariff_zones", "tariffs", [("ck_rate_positive", "rate_uah_kwh > 0")]),
        _sql_counts("baseline_consumption", "baseline", [
            ("ck_month", "month BETWEEN 1 AND 12"), ("ck_hour", "hour_of_day BETWEEN 0 AND 23"),
            ("ck_expected_positive", "expected_kwh >= 0")]),
        _sql_counts("solar_generation", "solar", [
            ("ck_solar_power", "power_kw >= 0"), ("ck_solar_energy", "energy_kwh >= 0"), ("ck_irradiance2", "irradiance_wm2 >= 0")]),
    ]
)


@query("check_violations", CHECK_SQL)
def _l1(t):
    return qa.check_violations(quality_tables(t))


@query(
    "check_battery",
    _sql_counts("battery_state", "battery", [("ck_soc_range", "soc_pct BETWEEN 0 AND 100"), ("ck_health_range", "health_pct BETWEEN 0 AND 100")]),
)
def _l2(t):
    return qa.check_battery(t.battery)


DUP_KEYS = {
    "measurements": ("dirty", ["meter_id", "ts"]),
    "weather_data": ("weather", ["object_id", "ts"]),
    "baseline_consumption": ("baseline", ["object_id", "month", "hour_of_day", "day_type"]),
    "energy_efficiency_metrics": ("metrics", ["object_id", "date"]),
    "solar_generation": ("solar", ["object_id", "ts"]),
    "battery_state": ("battery", ["object_id", "ts"]),
}


@query(
    "duplicate_keys",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, COUNT(*) AS duplicate_keys, CAST(coalesce(SUM(n), 0) AS BIGINT) AS duplicate_rows
        FROM (SELECT COUNT(*) AS n FROM {src} GROUP BY {", ".join(k)} HAVING COUNT(*) > 1)"""
        for t, (src, k) in DUP_KEYS.items()
    ),
)
def _l3(t):
    return qa.duplicate_keys(quality_tables(t), {k: v[1] for k, v in DUP_KEYS.items()})


@query(
    "orphans",
    """SELECT 'meters.object_id' AS relation, COUNT(*) AS orphans FROM meters WHERE object_id NOT IN (SELECT object_id FROM objects)
    UNION ALL SELECT 'measurements.meter_id', COUNT(*) FROM dirty WHERE meter_id NOT IN (SELECT meter_id FROM meters)
    UNION ALL SELECT 'baseline_consumption.object_id', COUNT(*) FROM baseline WHERE object_id NOT IN (SELECT object_id FROM objects)
    UNION ALL SELECT 'energy_efficiency_metrics.object_id', COUNT(*) FROM metrics WHERE object_id NOT IN (SELECT object_id FROM objects)""",
)
def _l4(t):
    return qa.orphans(quality_tables(t))


NULL_SRC = {"objects": "(SELECT *, 95.0 AS max_power_kw, 6 AS meter_count, '8-20' AS operation_mode, 22.0 AS avg_load_kw, "
            "5.0 AS min_load_kw, 38.0 AS max_load_kw FROM objects)",
            "meters": "meters", "measurements": "dirty", "weather_data": "weather", "tariff_zones": "tariffs",
            "baseline_consumption": "baseline", "energy_efficiency_metrics": "metrics", "solar_generation": "solar",
            "battery_state": "battery"}
# Required columns, stated here on their own and not read from the operator.
REQUIRED = {
    "objects": ["object_id", "name", "type", "location", "area_m2", "max_power_kw", "meter_count", "operation_mode", "avg_load_kw", "min_load_kw", "max_load_kw"],
    "meters": ["meter_id", "object_id", "name", "type", "level", "is_active"],
    "measurements": ["meter_id", "ts", "active_power_kw", "energy_kwh"],
    "weather_data": ["ts", "temperature_c", "solar_irradiance_wm2", "hdd", "cdd"],
    "tariff_zones": ["name", "tariff_name", "zone_type", "start_sec", "end_sec", "rate_uah_kwh"],
    "baseline_consumption": ["object_id", "month", "hour_of_day", "day_type", "expected_kwh"],
    "energy_efficiency_metrics": ["object_id", "date", "total_consumption_kwh", "specific_consumption_kwh_m2"],
    "solar_generation": ["ts", "power_kw", "energy_kwh", "irradiance_wm2"],
    "battery_state": ["ts", "soc_pct", "soc_kwh", "power_kw", "energy_kwh", "mode"],
}


@query(
    "null_violations",
    " UNION ALL ".join(
        _sql_counts(t, NULL_SRC[t], [(c, f"{c} IS NOT NULL") for c in cols], kind="column_name") for t, cols in REQUIRED.items()
    ),
)
def _l5(t):
    return qa.null_violations(quality_tables(t))


# Allowed values, stated here on their own and not read from the operator.
ALLOWED = {
    ("objects", "type"): ["polyclinic", "hospital", "school", "office", "residential", "industrial"],
    ("meters", "type"): ["main", "zone", "solar", "battery", "emergency"],
    ("tariff_zones", "zone_type"): ["day", "night", "peak", "off_peak"],
    ("baseline_consumption", "day_type"): ["weekday", "weekend", "holiday"],
    ("battery_state", "mode"): ["charging", "discharging", "idle"],
}
ENUM_SRC = {"objects": "objects", "meters": "meters", "tariff_zones": "tariffs", "baseline_consumption": "baseline", "battery_state": "battery"}


@query(
    "enum_violations",
    " UNION ALL ".join(
        _sql_counts(t, ENUM_SRC[t], [(col, f"{col} IN ({', '.join(repr(v) for v in allowed)})")], kind="column_name")
        for (t, col), allowed in ALLOWED.items()
    ),
)
def _l6(t):
    return qa.enum_violations(quality_tables(t))


@query(
    "load_quality",
    """SELECT 'measurements' AS table_name, kind, rule, violations, (SELECT COUNT(*) FROM dirty) AS rows FROM (
      SELECT 'check' AS kind, 'ck_power_non_negative' AS rule, COUNT(*) FILTER (active_power_kw < 0) AS violations FROM dirty
      UNION ALL SELECT 'check', 'ck_pf_range', COUNT(*) FILTER (power_factor < 0 OR power_factor > 1) FROM dirty
      UNION ALL SELECT 'check', 'ck_quality_flag', COUNT(*) FILTER (quality_flag NOT IN (-1, 0, 1)) FROM dirty
      UNION ALL SELECT 'not null', 'meter_id', COUNT(*) FILTER (meter_id IS NULL) FROM dirty
      UNION ALL SELECT 'not null', 'ts', COUNT(*) FILTER (ts IS NULL) FROM dirty
      UNION ALL SELECT 'not null', 'active_power_kw', COUNT(*) FILTER (active_power_kw IS NULL) FROM dirty
      UNION ALL SELECT 'not null', 'energy_kwh', COUNT(*) FILTER (energy_kwh IS NULL) FROM dirty)""",
)
def _l1_load(t):
    """The measurement rules, counted while the dirty readings are loaded."""
    path = io.scratch_path(t.spark, "observed", t.sf_dir)
    return qa.observed_load(t.dirty_measurements, "measurements", lambda df: io.bulk_load(df, path))


@query(
    "quarantine_split",
    """SELECT d.meter_id, d.ts, d.active_power_kw, d.power_factor, d.energy_kwh, d.quality_flag, d.voltage_v,
           concat_ws(',', CASE WHEN d.active_power_kw IS NULL THEN 'null_power' END,
                          CASE WHEN d.active_power_kw < 0 THEN 'negative_power' END,
                          CASE WHEN NOT d.power_factor BETWEEN 0 AND 1 THEN 'pf_range' END,
                          CASE WHEN d.quality_flag NOT IN (-1, 0, 1) THEN 'quality_flag' END,
                          CASE WHEN d.quality_flag = -1 THEN 'flagged_bad' END,
                          CASE WHEN mt.meter_id IS NULL THEN 'unknown_meter' END) AS reasons
    FROM dirty d LEFT JOIN meters mt ON mt.meter_id = d.meter_id
    WHERE d.active_power_kw IS NULL OR d.active_power_kw < 0 OR NOT d.power_factor BETWEEN 0 AND 1
       OR d.quality_flag NOT IN (-1, 0, 1) OR d.quality_flag = -1 OR mt.meter_id IS NULL""",
    ("active_power_kw", "power_factor", "energy_kwh", "voltage_v"),
)
def _l7(t):
    return qa.quarantine_split(t.dirty_measurements, t.meters)[1]


# ------------------------------------------------------------------ A
MEAS_ALL = "SELECT * FROM measurements"


def _written_measurements(t, name: str):
    path = io.scratch_path(t.spark, name, t.sf_dir)
    io.bulk_load(t.measurements, path)
    return path


@query(
    "scan_measurements",
    f"SELECT {', '.join(ac.MEASUREMENT_PROJECTION)} FROM measurements WHERE {UTC_RANGE}",
    ("active_power_kw", "reactive_power_kvar", "energy_kwh", "power_factor"),
)
def _a1(t):
    path = _written_measurements(t, "scan")
    return io.scan(t.spark, path, schemas.MEASUREMENTS, UTC_START, UTC_END, ac.MEASUREMENT_PROJECTION)


def _staged_measurements(t):
    """The measurement batch written once and read back, so several loads of it
    do not each re-derive it from the line items."""
    return io.scan(t.spark, _written_measurements(t, "batch"), schemas.MEASUREMENTS)


@query("bulk_load", MEAS_ALL, MEAS_DOUBLES)
def _a4(t):
    path = io.scratch_path(t.spark, "bulk", t.sf_dir)
    m = _staged_measurements(t)
    first = F.month("ts") <= 6
    io.bulk_load(m.filter(first), path, "append")
    io.bulk_load(m.filter(~first), path, "append")
    return io.scan(t.spark, path, schemas.MEASUREMENTS)


@query("idempotent_load", MEAS_ALL, MEAS_DOUBLES)
def _a5(t):
    path = io.scratch_path(t.spark, "idem", t.sf_dir)
    m = _staged_measurements(t)
    key = schemas.NATURAL_KEYS["measurements"]
    io.idempotent_load(t.spark, m.filter(F.month("ts") <= 6), path, schemas.MEASUREMENTS, key)
    io.idempotent_load(t.spark, m, path, schemas.MEASUREMENTS, key)
    io.idempotent_load(t.spark, m, path, schemas.MEASUREMENTS, key)  # re-run: appends nothing
    return io.scan(t.spark, path, schemas.MEASUREMENTS)


DAILY_SCHEMA = "object_id INT, day DATE, total_kwh DOUBLE, peak_kw DOUBLE, avg_kw DOUBLE, cost_uah DOUBLE, day_type STRING"


@query("report_csv", DAILY_SQL, ("total_kwh", "peak_kw", "avg_kw", "cost_uah"))
def _a7(t):
    from ..plans.catalog import START, END

    path = io.scratch_path(t.spark, "report", t.sf_dir)
    io.report_csv(an.daily_consumption(l1(t), START, END), path, order=["object_id", "day"])
    from pyspark.sql.types import _parse_datatype_string

    return io.read_csv(t.spark, path, _parse_datatype_string(DAILY_SCHEMA))


# ------------------------------------------------------------------ B14, B15
# Deletes of the first, a correction of noon, and new readings a year later.
CHANGED_SQL = """SELECT meter_id, ts, CASE WHEN hour(ts) = 12 THEN energy_kwh + 1 ELSE energy_kwh END AS energy_kwh, active_power_kw
    FROM meas WHERE dayofmonth(ts) <> 1
    UNION ALL
    SELECT meter_id, ts + INTERVAL 365 DAYS, energy_kwh, active_power_kw FROM meas WHERE dayofmonth(ts) = 2"""


@query("apply_changes", CHANGED_SQL, ("energy_kwh", "active_power_kw"))
def _b14(t):
    return jobs.apply_changes(*_change_set(t), ["meter_id", "ts"])


def _change_set(t):
    """The stored readings and the changes made of them; written once and read
    back, since both are read several times."""
    rows = t.measurements_nocum.select("meter_id", "ts", "energy_kwh", "active_power_kw")
    path = io.scratch_path(t.spark, "change-base", t.sf_dir)
    rows.write.parquet(path)
    base = t.spark.read.schema(rows.schema).parquet(path)
    d = F.dayofmonth("ts")
    deletes = base.filter(d == 1).withColumn("op", F.lit("D"))
    updates = base.filter((F.hour("ts") == 12) & (d != 1)).withColumn("energy_kwh", F.col("energy_kwh") + 1).withColumn("op", F.lit("U"))
    inserts = base.filter(d == 2).withColumn("ts", F.col("ts") + F.expr("INTERVAL 365 DAYS")).withColumn("op", F.lit("I"))
    return base, deletes.unionByName(updates).unionByName(inserts)


@query("change_write", CHANGED_SQL, ("energy_kwh", "active_power_kw"))
def _b14w(t):
    """The change set above written back to a stored table, as three sets one
    after the other, each a version."""
    base, changes = _change_set(t)
    path = io.scratch_path(t.spark, "months", t.sf_dir)
    table = MonthTable(t.spark, path, base.schema, ["meter_id", "ts"])
    table.create(base)
    for op in ("D", "U", "I"):
        table.apply(changes.filter(F.col("op") == op))
    return table.read()


@query(
    "change_violations",
    """SELECT meter_id, ts, 'I' AS op, 'existing key' AS reason FROM meas WHERE dayofmonth(ts) = 3
    UNION ALL SELECT meter_id, ts + INTERVAL 365 DAYS, 'U', 'missing key' FROM meas WHERE dayofmonth(ts) = 4
    UNION ALL SELECT meter_id, ts, 'D', 'repeated key' FROM meas WHERE dayofmonth(ts) = 5""",
)
def _b14v(t):
    """The change set above with faults: inserts of stored keys, updates of
    absent ones, and keys that are changed twice."""
    base, changes = _change_set(t)
    key, d = ["meter_id", "ts"], F.dayofmonth("ts")
    good = changes.filter(~d.isin(3, 4, 5) | (F.col("op") == "I"))
    existing = base.filter(d == 3).withColumn("op", F.lit("I"))
    missing = base.filter(d == 4).withColumn("ts", F.col("ts") + F.expr("INTERVAL 365 DAYS")).withColumn("op", F.lit("U"))
    twice = base.filter(d == 5).withColumn("op", F.lit("D"))
    faulty = good.unionByName(existing).unionByName(missing).unionByName(twice).unionByName(twice)
    return jobs.change_violations(base, faulty, key)


@query(
    "cascade_delete",
    """SELECT 'objects' AS table_name, COUNT(*) AS rows FROM objects WHERE object_id <> 2
    UNION ALL SELECT 'meters', COUNT(*) FROM meters WHERE object_id <> 2
    UNION ALL SELECT 'measurements', COUNT(*) FROM meas WHERE meter_id NOT IN (SELECT meter_id FROM meters WHERE object_id = 2)
    UNION ALL SELECT 'baseline_consumption', COUNT(*) FROM baseline WHERE object_id <> 2
    UNION ALL SELECT 'energy_efficiency_metrics', COUNT(*) FROM metrics WHERE object_id <> 2
    UNION ALL SELECT 'weather_data', COUNT(*) FROM weather WHERE object_id <> 2
    UNION ALL SELECT 'solar_generation', COUNT(*) FROM solar WHERE object_id <> 2
    UNION ALL SELECT 'battery_state', COUNT(*) FROM battery WHERE object_id <> 2""",
)
def _b15(t):
    tables = {
        "objects": t.objects, "meters": t.meters, "measurements": t.measurements_nocum,
        "baseline_consumption": t.baseline, "energy_efficiency_metrics": t.daily_metrics,
        "weather_data": t.weather, "solar_generation": t.solar, "battery_state": t.battery,
    }
    gone = t.objects.filter(F.col("object_id") == 2).select("object_id")
    out = jobs.cascade_delete(tables, gone)
    return ac.row_count(out)

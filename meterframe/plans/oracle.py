"""Independent DuckDB SQL for every registered query.

One shared ``WITH`` prefix derives the metering tables from the driver's
test tables exactly as ``sources.fixtures`` does in Spark; each query then
states the reference semantics in plain SQL.  Floating outputs are rounded to
6 places on both sides (see ``catalog.finish``).
"""

from __future__ import annotations

from .. import config as C

TZ = C.REPORT_TIMEZONE
START, END, YEAR = "2025-01-01", "2025-12-31", 2025


def _dlist(values) -> str:
    return "[" + ", ".join(repr(float(v)) for v in values) + "]::DOUBLE[]"


_SLOTS = ", ".join(f"({s}, '{n}', '{t}', {lv}, '{loc}')" for s, n, t, lv, loc in C.METER_SLOTS)
_HOLIDAYS = ", ".join(str(m * 100 + d) for m, d in C.HOLIDAYS)


def local(ts: str) -> str:
    return f"timezone('{TZ}', timezone('UTC', {ts}))"


PREFIX = f"""
WITH raw AS (
  SELECT CAST(1 + l_suppkey // 4 AS INTEGER) AS object_id,
         CAST(2 + l_partkey % 5 AS INTEGER) AS slot,
         CAST(TIMESTAMP '2025-01-01 00:00:00'
              + to_hours(CAST((date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) % 365) * 24
                              + l_orderkey % 24 AS BIGINT)) AS TIMESTAMP) AS ts,
         l_quantity, l_linenumber, l_orderkey
  FROM lineitem
),
sub AS (
  SELECT object_id, slot, ts,
         SUM(l_quantity) AS energy_kwh,
         MAX(l_quantity) AS active_power_kw,
         SUM(CASE l_linenumber % 3 WHEN 0 THEN -l_quantity WHEN 1 THEN l_quantity ELSE 0.0 END) AS battery_power_kw,
         MAX(l_orderkey) AS max_orderkey
  FROM raw GROUP BY object_id, slot, ts
),
dirty AS (
  SELECT CAST(CASE WHEN l_orderkey % 73 = 0 THEN 99 ELSE (object_id - 1) * 6 + slot END AS INTEGER) AS meter_id, ts,
         CASE WHEN l_orderkey % 83 = 0 THEN NULL WHEN l_orderkey % 97 = 0 THEN -l_quantity ELSE l_quantity END
           AS active_power_kw,
         CASE WHEN l_orderkey % 89 = 0 THEN CAST(1.2 AS DOUBLE) ELSE CAST(0.80 + (hour(ts) % 20) * 0.01 AS DOUBLE) END
           AS power_factor,
         l_quantity AS energy_kwh,
         CAST(CASE WHEN l_orderkey % 79 = 0 THEN 7 ELSE 1 END AS SMALLINT) AS quality_flag,
         CAST(210 + (hour(ts) * 3) % 26 AS DOUBLE) AS voltage_v
  FROM raw
),
tariffs AS (
  SELECT * FROM (VALUES (1, 'Day zone', 'Two-zone tariff', 'day', 25200, 82800, CAST(6.9 AS DOUBLE), TRUE),
                        (2, 'Night zone', 'Two-zone tariff', 'night', 82800, 25200, CAST(5.6 AS DOUBLE), TRUE))
         t(zone_id, name, tariff_name, zone_type, start_sec, end_sec, rate_uah_kwh, is_active)
),
mainr AS (
  SELECT object_id, ts, SUM(energy_kwh) AS energy_kwh, SUM(active_power_kw) AS active_power_kw
  FROM sub GROUP BY object_id, ts
),
readings AS (
  SELECT object_id, slot, ts, energy_kwh, active_power_kw FROM sub
  UNION ALL
  SELECT object_id, 1 AS slot, ts, energy_kwh, active_power_kw FROM mainr
),
objects AS (
  SELECT object_id, 'Site ' || object_id AS name, 'polyclinic' AS type, 'Kyiv' AS location,
         ({_dlist(C.SITE_AREAS_M2)})[((object_id - 1) % 3) + 1] AS area_m2
  FROM (SELECT DISTINCT CAST(1 + s_suppkey // 4 AS INTEGER) AS object_id FROM supplier)
),
tariff_versions AS (
  SELECT object_id, zone_id, zone_type, start_sec, end_sec, rate_uah_kwh + (n * 10 + object_id % 7) / 100.0::DOUBLE AS rate_uah_kwh, TRUE AS is_active,
         CASE WHEN n > 0 THEN frm + to_hours(object_id % 30) END AS valid_from, till + to_hours(object_id % 30) AS valid_to
  FROM objects, tariffs, (VALUES (0, TIMESTAMP '2025-01-01', TIMESTAMP '2025-04-01'), (1, TIMESTAMP '2025-04-01', TIMESTAMP '2025-07-01'),
                                 (2, TIMESTAMP '2025-07-01', TIMESTAMP '2025-11-01'), (3, TIMESTAMP '2025-12-01', NULL)) quarter(n, frm, till)
  UNION ALL SELECT object_id, 1, 'day', 36000, 64800, 3.5, TRUE, TIMESTAMP '2025-05-10 05:30:00', TIMESTAMP '2025-05-20' FROM objects
  UNION ALL SELECT object_id, 1, 'day', 36000, 64800, 0.1, FALSE, TIMESTAMP '2025-06-01', TIMESTAMP '2025-06-30' FROM objects
),
meters AS (
  SELECT CAST((o.object_id - 1) * 6 + s.slot AS INTEGER) AS meter_id, o.object_id, s.name, s.type,
         CAST(s.level AS SMALLINT) AS level, s.location, s.slot,
         printf('SN-%04d-2025', (o.object_id - 1) * 6 + s.slot) AS serial_number, TRUE AS is_active
  FROM objects o CROSS JOIN (VALUES {_SLOTS}) s(slot, name, type, level, location)
),
meas AS (
  SELECT CAST((object_id - 1) * 6 + slot AS INTEGER) AS meter_id, ts, active_power_kw, energy_kwh,
         CAST(0.80 + (hour(ts) % 20) * 0.01 AS DOUBLE) AS power_factor,
         CAST(210 + (hour(ts) * 3) % 26 AS DOUBLE) AS voltage_v,
         CAST(1 AS SMALLINT) AS quality_flag
  FROM readings
),
measurements AS (
  SELECT meter_id, ts, active_power_kw,
         CASE WHEN power_factor BETWEEN 0 AND 1 THEN round(active_power_kw * tan(acos(power_factor)), 3) END AS reactive_power_kvar,
         voltage_v,
         CASE WHEN active_power_kw > 0
              THEN round(active_power_kw * 1000.0 / (voltage_v * power_factor * sqrt(3.0)), 2) ELSE 0.0 END AS current_a,
         power_factor, energy_kwh,
         round(SUM(energy_kwh) OVER (PARTITION BY meter_id ORDER BY ts
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 3) AS cumulative_kwh,
         quality_flag
  FROM meas
),
l1 AS (
  SELECT mt.object_id, m.ts,
         CAST(m.lt AS DATE) AS day,
         CAST(month(m.lt) AS INTEGER) AS month,
         CAST(year(m.lt) AS INTEGER) AS year,
         CAST(hour(m.lt) AS INTEGER) AS hour,
         CASE WHEN dayofweek(m.lt) IN (0, 6) THEN 'weekend' ELSE 'weekday' END AS day_type,
         m.active_power_kw, m.energy_kwh, m.power_factor,
         CASE WHEN hour(m.lt) BETWEEN 7 AND 22 THEN 'day' ELSE 'night' END AS tariff_zone,
         CASE WHEN hour(m.lt) BETWEEN 7 AND 22 THEN m.energy_kwh * CAST(6.9 AS DOUBLE)
              ELSE m.energy_kwh * CAST(5.6 AS DOUBLE) END AS cost_uah
  FROM (SELECT *, {local('ts')} AS lt FROM meas) m
  JOIN meters mt ON mt.meter_id = m.meter_id
  WHERE mt.type = 'main' AND mt.level = 1
),
wbase AS (
  SELECT object_id, ts, CAST(month(lt) AS INTEGER) AS m, CAST(dayofyear(lt) AS INTEGER) AS doy,
         CAST(hour(lt) AS INTEGER) AS h
  FROM (SELECT object_id, ts, {local('ts')} AS lt
        FROM (SELECT object_id, TIMESTAMP '2025-01-01 00:00:00' + to_hours(h) AS ts FROM objects, range(8760) r(h)))
),
wtemp AS (
  SELECT *,
         round(({_dlist(C.MONTHLY_AVG_TEMP_C)})[m] + 1.5 * sin((doy - 15) * 2 * pi() / 365)
               + 4.0 * cos((h - 14) * pi() / 12) + CAST(((doy * 7 + h * 13) % 17 - 8) * 0.2 AS DOUBLE), 2) AS temperature_c,
         CAST((doy * 31 + h * 7) % 101 AS DOUBLE) AS cloud_cover_pct
  FROM wbase
),
weather_full AS (
  SELECT object_id, ts, temperature_c,
         CAST(40 + (doy * 13 + h * 5) % 50 AS DOUBLE) AS humidity_pct,
         CAST((doy * 3 + h) % 11 AS DOUBLE) / 2 AS wind_speed_ms,
         round(CASE WHEN abs(h - 12.5) >= 5.5 + 1.5 * sin((m - 6) * pi() / 6) THEN 0.0
               ELSE greatest(0.0, ({_dlist(C.MONTHLY_PEAK_IRRADIANCE_WM2)})[m]
                    * greatest(0.0, cos((h - 12.5) * pi() / ((5.5 + 1.5 * sin((m - 6) * pi() / 6)) * 2)))
                    * (1.0 - 0.75 * (cloud_cover_pct / 100.0))) END, 2) AS solar_irradiance_wm2,
         cloud_cover_pct,
         CAST(0.0 AS DOUBLE) AS precipitation_mm,
         round(greatest(0.0, 18.0 - temperature_c) / 24, 4) AS hdd,
         round(greatest(0.0, temperature_c - 22.0) / 24, 4) AS cdd,
         'fixture' AS data_source,
         (doy + h) % 11 = 5 AS gap, m, doy, h
  FROM wtemp
),
weather AS (
  SELECT object_id, ts, temperature_c, humidity_pct, wind_speed_ms, solar_irradiance_wm2, cloud_cover_pct,
         precipitation_mm, hdd, cdd, data_source
  FROM weather_full
),
weather_gappy AS (SELECT * FROM weather_full WHERE NOT gap),
solar AS (
  SELECT object_id, ts, active_power_kw AS power_kw, energy_kwh,
         round(active_power_kw / 35.0 * 100.0, 2) AS efficiency_pct, CAST(0.0 AS DOUBLE) AS curtailed_kwh,
         w.solar_irradiance_wm2 AS irradiance_wm2, w.temperature_c, round(active_power_kw / CAST(0.97 AS DOUBLE), 3) AS dc_power_kw
  FROM sub JOIN weather w USING (object_id, ts) WHERE slot = 5
),
battery AS (
  SELECT object_id, ts, soc_pct, round(soc_pct * 25.0 / 100, 3) AS soc_kwh, battery_power_kw AS power_kw,
         abs(battery_power_kw) AS energy_kwh,
         CASE WHEN battery_power_kw > 0 THEN 'charging' WHEN battery_power_kw < 0 THEN 'discharging' ELSE 'idle' END AS mode,
         round(48.0 + (soc_pct - 50) * 0.1, 2) AS voltage_v, CAST(100.0 AS DOUBLE) AS health_pct
  FROM (SELECT *, CAST(10 + max_orderkey % 86 AS DOUBLE) AS soc_pct FROM sub WHERE slot = 6)
),
battery_full AS (
  SELECT b.*, w.temperature_c,
         round(SUM(CASE WHEN mode = 'discharging' THEN abs(power_kw) / 25.0 ELSE 0.0 END)
               OVER (PARTITION BY object_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS cycle_count
  FROM battery b JOIN weather w USING (object_id, ts)
),
baseline AS (
  SELECT l1.object_id, l1.month, l1.hour AS hour_of_day, l1.day_type,
         round(avg(l1.energy_kwh), 4) AS expected_kwh,
         round(stddev_pop(l1.energy_kwh), 4) AS std_dev_kwh,
         round(CASE WHEN count(*) > 1 AND max(w.temperature_c) > min(w.temperature_c)
                    THEN regr_slope(l1.energy_kwh, w.temperature_c) ELSE 0.0 END, 6) AS temperature_coeff,
         CAST(count(*) AS INTEGER) AS sample_count
  FROM l1 JOIN weather w ON w.object_id = l1.object_id AND w.ts = l1.ts
  GROUP BY l1.object_id, l1.month, l1.hour, l1.day_type
),
kpi_main AS (
  SELECT object_id, day, SUM(energy_kwh) AS total, MAX(active_power_kw) AS peak, AVG(active_power_kw) AS avg,
         SUM(CASE WHEN hour >= 7 AND hour < 23 THEN energy_kwh * CAST(6.9 AS DOUBLE) ELSE 0.0 END) AS cost_day,
         SUM(CASE WHEN NOT (hour >= 7 AND hour < 23) THEN energy_kwh * CAST(5.6 AS DOUBLE) ELSE 0.0 END) AS cost_night
  FROM l1 GROUP BY object_id, day
),
kpi_solar AS (
  SELECT s.object_id, CAST({local('s.ts')} AS DATE) AS day, SUM(s.energy_kwh) AS solar
  FROM solar s GROUP BY ALL
),
kpi_bat AS (
  SELECT b.object_id, CAST({local('b.ts')} AS DATE) AS day,
         SUM(CASE WHEN b.mode = 'charging' THEN b.energy_kwh ELSE 0.0 END) AS ch,
         SUM(CASE WHEN b.mode = 'discharging' THEN b.energy_kwh ELSE 0.0 END) AS dis
  FROM battery b GROUP BY ALL
),
kpi AS (
  SELECT k.object_id, k.day, k.total, k.peak, k.avg, k.cost_day, k.cost_night,
         coalesce(s.solar, 0.0) AS solar, coalesce(b.ch, 0.0) AS ch, coalesce(b.dis, 0.0) AS dis, o.area_m2
  FROM kpi_main k
  LEFT JOIN kpi_solar s ON s.object_id = k.object_id AND s.day = k.day
  LEFT JOIN kpi_bat b ON b.object_id = k.object_id AND b.day = k.day
  JOIN objects o ON o.object_id = k.object_id
),
metrics AS (
  SELECT object_id, day AS date,
         round(total, 3) AS total_consumption_kwh,
         round(solar, 3) AS solar_generation_kwh,
         round(ch, 3) AS battery_charge_kwh,
         round(dis, 3) AS battery_discharge_kwh,
         round(greatest(0.0, total - solar - dis), 3) AS grid_import_kwh,
         CAST(0.0 AS DOUBLE) AS grid_export_kwh,
         round(total / area_m2, 5) AS specific_consumption_kwh_m2,
         round(peak, 3) AS peak_demand_kw,
         round(avg, 3) AS avg_demand_kw,
         round(CASE WHEN peak > 0 THEN avg / peak ELSE 0.0 END, 4) AS load_factor,
         round(CASE WHEN avg > 0 THEN peak / avg ELSE 0.0 END, 4) AS peak_to_avg_ratio,
         round(CASE WHEN solar > 0 THEN least(solar, total) / solar ELSE 0.0 END, 4) AS self_consumption_ratio,
         round(cost_day + cost_night, 2) AS cost_uah,
         round(cost_day, 2) AS cost_day_uah,
         round(cost_night, 2) AS cost_night_uah,
         round(greatest(0.0, total - solar - dis) * CAST(0.302 AS DOUBLE), 3) AS co2_kg
  FROM kpi
)
"""

DAYS = f"day BETWEEN DATE '{START}' AND DATE '{END}'"


def q(body: str, doubles: tuple[str, ...] = ()) -> str:
    """Prefix + body, with the listed double columns rounded to 6 places."""
    if not doubles:
        return PREFIX + body
    repl = ", ".join(f"round({c}, 6) AS {c}" for c in doubles)
    return PREFIX + f"SELECT * REPLACE ({repl}) FROM ({body}) _q"


ORACLE: dict[str, str] = {}


def register(name: str, body: str, doubles: tuple[str, ...] = ()) -> None:
    ORACLE[name] = q(body, doubles)

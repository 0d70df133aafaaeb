"""Typed schemas and natural keys of the metering tables.

Timestamps are ``timestamp_ntz`` holding UTC; reports localise explicitly.
Times of day are integer seconds (Spark's TIME type is off by default).
"""

from __future__ import annotations

from pyspark.sql import types as T

TS = T.TimestampNTZType()
D = T.DoubleType()
I = T.IntegerType()
S = T.StringType()
SH = T.ShortType()


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, nullable) for name, dtype, nullable in fields])


OBJECTS = _struct(
    ("object_id", I, False),
    ("name", S, False),
    ("type", S, False),
    ("location", S, True),
    ("area_m2", D, True),
    ("max_power_kw", D, True),
    ("meter_count", SH, True),
    ("operation_mode", S, True),
    ("avg_load_kw", D, True),
    ("min_load_kw", D, True),
    ("max_load_kw", D, True),
)

METERS = _struct(
    ("meter_id", I, False),
    ("object_id", I, False),
    ("name", S, False),
    ("type", S, False),
    ("level", SH, False),
    ("location", S, True),
    ("serial_number", S, True),
    ("is_active", T.BooleanType(), True),
    ("installed_at", TS, True),
)

MEASUREMENTS = _struct(
    ("meter_id", I, False),
    ("ts", TS, False),
    ("active_power_kw", D, True),
    ("reactive_power_kvar", D, True),
    ("voltage_v", D, True),
    ("current_a", D, True),
    ("power_factor", D, True),
    ("energy_kwh", D, True),
    ("cumulative_kwh", D, True),
    ("quality_flag", SH, True),
)

WEATHER = _struct(
    ("object_id", I, False),
    ("ts", TS, False),
    ("temperature_c", D, True),
    ("humidity_pct", D, True),
    ("wind_speed_ms", D, True),
    ("solar_irradiance_wm2", D, True),
    ("cloud_cover_pct", D, True),
    ("precipitation_mm", D, True),
    ("hdd", D, True),
    ("cdd", D, True),
    ("data_source", S, True),
)

TARIFF_ZONES = _struct(
    ("zone_id", I, False),
    ("name", S, False),
    ("tariff_name", S, False),
    ("zone_type", S, False),
    ("start_sec", I, False),
    ("end_sec", I, False),
    ("rate_uah_kwh", D, False),
    ("is_active", T.BooleanType(), True),
    ("valid_from", TS, True),
    ("valid_to", TS, True),
)

BASELINE = _struct(
    ("object_id", I, False),
    ("month", I, False),
    ("hour_of_day", I, False),
    ("day_type", S, False),
    ("expected_kwh", D, True),
    ("std_dev_kwh", D, True),
    ("temperature_coeff", D, True),
    ("sample_count", I, True),
)

KPI_COLUMNS = [
    "total_consumption_kwh",
    "solar_generation_kwh",
    "battery_charge_kwh",
    "battery_discharge_kwh",
    "grid_import_kwh",
    "grid_export_kwh",
    "specific_consumption_kwh_m2",
    "peak_demand_kw",
    "avg_demand_kw",
    "load_factor",
    "peak_to_avg_ratio",
    "self_consumption_ratio",
    "cost_uah",
    "cost_day_uah",
    "cost_night_uah",
    "co2_kg",
]

DAILY_METRICS = _struct(
    ("object_id", I, False),
    ("date", T.DateType(), False),
    *[(c, D, True) for c in KPI_COLUMNS],
)

SOLAR = _struct(
    ("object_id", I, False),
    ("ts", TS, False),
    ("power_kw", D, True),
    ("energy_kwh", D, True),
    ("efficiency_pct", D, True),
    ("curtailed_kwh", D, True),
    ("irradiance_wm2", D, False),
    ("temperature_c", D, True),
    ("dc_power_kw", D, True),
)

BATTERY = _struct(
    ("object_id", I, False),
    ("ts", TS, False),
    ("soc_pct", D, True),
    ("soc_kwh", D, True),
    ("power_kw", D, True),
    ("energy_kwh", D, True),
    ("mode", S, True),
    ("voltage_v", D, True),
    ("health_pct", D, True),
    ("temperature_c", D, True),
    ("cycle_count", D, True),
)

# Natural (unique) keys, used by the duplicate / idempotent-load operators.
NATURAL_KEYS = {
    "objects": ["object_id"],
    "meters": ["meter_id"],
    "measurements": ["meter_id", "ts"],
    "weather_data": ["object_id", "ts"],
    "tariff_zones": ["zone_id"],
    "baseline_consumption": ["object_id", "month", "hour_of_day", "day_type"],
    "energy_efficiency_metrics": ["object_id", "date"],
    "solar_generation": ["object_id", "ts"],
    "battery_state": ["object_id", "ts"],
}

SCHEMAS = {
    "objects": OBJECTS,
    "meters": METERS,
    "measurements": MEASUREMENTS,
    "weather_data": WEATHER,
    "tariff_zones": TARIFF_ZONES,
    "baseline_consumption": BASELINE,
    "energy_efficiency_metrics": DAILY_METRICS,
    "solar_generation": SOLAR,
    "battery_state": BATTERY,
}

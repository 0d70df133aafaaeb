"""Configuration literals for the metering model.

Everything a query needs from configuration is a plain Python value here and
becomes a literal in a column expression (``F.lit``) or a tiny broadcast
dimension.  Nothing is read from YAML or environment variables.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# These must equal the configuration of the modelled system for
# results to be right.  Kept together, in natural order, as plain text.
# ---------------------------------------------------------------------------

REPORT_TIMEZONE = "Europe/Kyiv"

# Two-zone tariff: (zone_id, name, zone_type, start "HH:MM:SS", end "HH:MM:SS", rate UAH/kWh)
TARIFF_NAME = "Two-zone tariff"
TARIFF_ZONES = [
    (1, "Day zone", "day", "07:00:00", "23:00:00", 6.9),
    (2, "Night zone", "night", "23:00:00", "07:00:00", 5.6),
]
DEFAULT_DAY_RATE = 6.9
DEFAULT_NIGHT_RATE = 5.6
DAY_ZONE_FIRST_HOUR = 7  # local hours 7..22 are the day zone
DAY_ZONE_LAST_HOUR = 22

# Hourly load profile, factor of the average load for local hours 0..23.
HOURLY_LOAD_PROFILE = [
    0.10, 0.09, 0.08, 0.08, 0.08, 0.09, 0.12, 0.20, 0.60, 0.85, 1.00, 1.00,
    0.92, 0.90, 1.00, 0.98, 0.95, 0.85, 0.65, 0.35, 0.15, 0.11, 0.10, 0.10,
]

# Monthly climatology, January..December.
MONTHLY_AVG_TEMP_C = [-3.2, -2.1, 3.8, 12.6, 18.9, 22.4, 24.3, 23.8, 17.1, 9.8, 2.7, -1.4]
MONTHLY_PEAK_IRRADIANCE_WM2 = [45, 85, 155, 230, 295, 320, 335, 295, 210, 120, 55, 35]

# Climatology shape: yearly trend and daily swing of temperature, daylight
# window and cloud cover used by the weather fill formulas.
TEMP_TREND_AMPLITUDE_C = 1.5
TEMP_TREND_PHASE_DAY = 15
TEMP_DIURNAL_AMPLITUDE_C = 4.0
TEMP_DIURNAL_PEAK_HOUR = 14
DAYLIGHT_CENTER_HOUR = 12.5
DAYLIGHT_HALF_BASE_H = 5.5
DAYLIGHT_HALF_AMPLITUDE_H = 1.5
DAYLIGHT_LONGEST_MONTH = 6
CLOUD_MEAN_PCT = 57.5
CLOUD_AMPLITUDE_PCT = 17.5
CLOUD_PEAK_MONTH = 7
CLOUD_IRRADIANCE_LOSS = 0.75  # clear-sky fraction lost at 100 % cloud
STC_IRRADIANCE_WM2 = 1000.0

# Battery terminal voltage: nominal at 50 % soc, slope per soc percent.
BATTERY_NOMINAL_V = 48.0
BATTERY_V_PER_SOC_PCT = 0.1

# Public holidays as (month, day).
HOLIDAYS = [(1, 1), (1, 7), (3, 8), (5, 1), (6, 8), (6, 28), (8, 24), (10, 14), (12, 25)]

DAY_TYPE_FACTORS = {"weekday": 1.0, "weekend": 0.72, "holiday": 0.65}
SEASONAL_FACTORS = {"winter": 1.18, "spring": 0.95, "summer": 1.08, "autumn": 0.92}

HEATING_THRESHOLD_C = 15.0
COOLING_THRESHOLD_C = 22.0
HEATING_COEFF_KW_PER_C = 0.35
COOLING_COEFF_KW_PER_C = 0.28
HDD_BASE_C = 18.0
CDD_BASE_C = 22.0

AVG_LOAD_KW = 22.0
MIN_LOAD_KW = 5.0
MAX_LOAD_KW = 38.0

# Shares of the total load per zone meter slot; the rest is unmetered.
ZONE_SHARES = [(2, 0.30), (3, 0.18), (4, 0.32)]

SOLAR_CAPACITY_KW = 35.0
INVERTER_EFFICIENCY = 0.97
SOLAR_TEMP_COEFF_PER_C = 0.004
SOLAR_REFERENCE_TEMP_C = 25.0
SOLAR_GENERATING_KW = 0.1

BATTERY_CAPACITY_KWH = 25.0

CO2_KG_PER_KWH = 0.302
ANOMALY_THRESHOLD_PCT = 20.0  # report queries (percent)
ANOMALY_THRESHOLD_FRACTION = 0.20  # service check (fraction)
BASELINE_WINDOW_DAYS = 30
SPECIFIC_NORMS_KWH_M2_YEAR = (150.0, 200.0)
SPECIFIC_BAND_LIMITS = (150.0 / 12, 130.0 / 12)  # monthly kWh/m2: above first = high, above second = mid

# Site areas, cycled over object ids 1, 2, 3, 4, ...
SITE_AREAS_M2 = [850.0, 1200.0, 640.0]

# Allowed values of the enumerations.
OBJECT_TYPES = ["polyclinic", "hospital", "school", "office", "residential", "industrial"]
METER_TYPES = ["main", "zone", "solar", "battery", "emergency"]
DAY_TYPES = ["weekday", "weekend", "holiday"]
TARIFF_ZONE_TYPES = ["day", "night", "peak", "off_peak"]
BATTERY_MODES = ["charging", "discharging", "idle"]
QUALITY_FLAGS = [-1, 0, 1]
METER_LEVELS = [1, 2, 3]

# Meter slots per site: (slot, name, type, level, location)
METER_SLOTS = [
    (1, "Main incomer", "main", 1, "Switch room"),
    (2, "Zone HVAC", "zone", 2, "Technical floor"),
    (3, "Zone lighting", "zone", 2, "Floor 1 panel"),
    (4, "Zone medical", "zone", 2, "Floor 2 panel"),
    (5, "Solar PV", "solar", 3, "Roof"),
    (6, "Battery storage", "battery", 3, "Switch room"),
]
METERS_PER_SITE = len(METER_SLOTS)

# Column defaults applied on load when a value is absent.
MEASUREMENT_DEFAULTS = {
    "reactive_power_kvar": 0.0,
    "voltage_v": 220.0,
    "power_factor": 0.92,
    "quality_flag": 1,
}


"""Per-row energy formulas as Spark column expressions.

All are deterministic, JVM-side and codegen-friendly.  Lookup tables of a
dozen entries are array literals indexed with ``element_at``, not joins.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C
from .calendar import col
from .rounding import rnd


def _arr(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def monthly_avg_temp(month) -> Column:
    return F.element_at(_arr(C.MONTHLY_AVG_TEMP_C), col(month))


def monthly_peak_irradiance(month) -> Column:
    return F.element_at(_arr(C.MONTHLY_PEAK_IRRADIANCE_WM2), col(month))


def hourly_profile(hour, profile=None) -> Column:
    return F.element_at(_arr(profile or C.HOURLY_LOAD_PROFILE), col(hour) + 1)


def degree_days(temp) -> tuple[Column, Column]:
    """(hdd, cdd) per hour: max(0, 18 - t)/24 and max(0, t - 22)/24, round 4."""
    t = col(temp)
    hdd = rnd(F.greatest(F.lit(0.0), F.lit(C.HDD_BASE_C) - t) / 24, 4)
    cdd = rnd(F.greatest(F.lit(0.0), t - F.lit(C.CDD_BASE_C)) / 24, 4)
    return hdd, cdd


def temperature_adjustment(temp) -> Column:
    """Heating / cooling kW added to the load model (F8)."""
    t = col(temp)
    return (
        F.when(t < C.HEATING_THRESHOLD_C, (F.lit(C.HEATING_THRESHOLD_C) - t) * F.lit(C.HEATING_COEFF_KW_PER_C))
        .when(t > C.COOLING_THRESHOLD_C, (t - F.lit(C.COOLING_THRESHOLD_C)) * F.lit(C.COOLING_COEFF_KW_PER_C))
        .otherwise(F.lit(0.0))
    )


def expected_load(hour, day_factor, season_factor, temp) -> Column:
    """Noise-free load model: avg * profile[hour] * day * season + F8, clipped, round 3."""
    raw = (
        F.lit(C.AVG_LOAD_KW) * hourly_profile(hour) * col(day_factor) * col(season_factor)
        + temperature_adjustment(temp)
    )
    return rnd(F.least(F.greatest(raw, F.lit(C.MIN_LOAD_KW)), F.lit(C.MAX_LOAD_KW)), 3)


def solar_dc_kw(irradiance, temp, capacity_kw: float = C.SOLAR_CAPACITY_KW) -> Column:
    """dc = irr/1000 * capacity * (1 - max(0, (t - 25) * 0.004))."""
    derate = F.lit(1.0) - F.greatest(
        F.lit(0.0), (col(temp) - F.lit(C.SOLAR_REFERENCE_TEMP_C)) * F.lit(C.SOLAR_TEMP_COEFF_PER_C)
    )
    return col(irradiance) / C.STC_IRRADIANCE_WM2 * F.lit(capacity_kw) * derate


def solar_ac_kw(dc, capacity_kw: float = C.SOLAR_CAPACITY_KW) -> Column:
    return F.least(F.greatest(col(dc) * F.lit(C.INVERTER_EFFICIENCY), F.lit(0.0)), F.lit(capacity_kw))


def solar_efficiency_pct(ac, capacity_kw: float = C.SOLAR_CAPACITY_KW) -> Column:
    return col(ac) / F.lit(capacity_kw) * 100.0


def temperature_climatology(month, doy, hour) -> Column:
    """Monthly base + 1.5 sin((doy-15) 2pi/365) + 4 cos((h-14) pi/12)."""
    trend = F.lit(C.TEMP_TREND_AMPLITUDE_C) * F.sin((col(doy) - C.TEMP_TREND_PHASE_DAY) * 2 * F.pi() / 365)
    diurnal = F.lit(C.TEMP_DIURNAL_AMPLITUDE_C) * F.cos((col(hour) - C.TEMP_DIURNAL_PEAK_HOUR) * F.pi() / 12)
    return monthly_avg_temp(month) + trend + diurnal


def cloud_climatology(month) -> Column:
    """Seasonal mean cloud cover, percent."""
    return F.lit(C.CLOUD_MEAN_PCT) - F.lit(C.CLOUD_AMPLITUDE_PCT) * F.cos((col(month) - C.CLOUD_PEAK_MONTH) * F.pi() / 6)


def irradiance_climatology(month, hour, cloud) -> Column:
    """Clear-sky cosine bell scaled by cloud, 0 outside daylight."""
    half = F.lit(C.DAYLIGHT_HALF_BASE_H) + F.lit(C.DAYLIGHT_HALF_AMPLITUDE_H) * F.sin(
        (col(month) - C.DAYLIGHT_LONGEST_MONTH) * F.pi() / 6
    )
    offset = col(hour) - F.lit(C.DAYLIGHT_CENTER_HOUR)
    bell = F.greatest(F.lit(0.0), F.cos(offset * F.pi() / (half * 2)))
    clear = monthly_peak_irradiance(month) * bell
    value = clear * (F.lit(1.0) - F.lit(C.CLOUD_IRRADIANCE_LOSS) * (col(cloud) / 100.0))
    return F.when(F.abs(offset) >= half, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), value))


def current_a(power_kw, voltage, pf) -> Column:
    """I = P*1000 / (V * pf * sqrt 3), 0 when P <= 0; round 2."""
    p = col(power_kw)
    return F.when(
        p > 0, rnd(p * 1000.0 / (col(voltage) * col(pf) * F.lit(math.sqrt(3.0))), 2)
    ).otherwise(F.lit(0.0))


def reactive_kvar(power_kw, pf) -> Column:
    """Q = P * tan(acos(pf)); NULL for pf outside [0, 1] instead of NaN; round 3."""
    p = col(pf)
    return F.when(p.between(0, 1), rnd(col(power_kw) * F.tan(F.acos(p)), 3))


def battery_soc_pct(soc_kwh, capacity_kwh: float = C.BATTERY_CAPACITY_KWH) -> Column:
    return col(soc_kwh) / F.lit(capacity_kwh) * 100.0


def battery_voltage(soc_pct) -> Column:
    """48 V nominal, 0.1 V per soc percent around 50 %."""
    return rnd(F.lit(C.BATTERY_NOMINAL_V) + (col(soc_pct) - 50) * C.BATTERY_V_PER_SOC_PCT, 2)


def safe_ratio(num, den) -> Column:
    """num / NULLIF(den, 0) (F15): NULL instead of an ANSI divide-by-zero error."""
    return col(num) / F.nullif(col(den), F.lit(0))


def energy_from_power(power_kw, interval_hours: float = 1.0) -> Column:
    """kWh over a fixed interval: kW * hours."""
    return col(power_kw) * F.lit(float(interval_hours))

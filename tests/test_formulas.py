"""Hand-computed values for the per-row formulas (F7-F16) and rounding."""

import math

import pytest
from pyspark.sql import functions as F

from meterframe.functions import physics as ph
from meterframe.functions.rounding import rnd


def one(spark, expr, schema="x double", row=(0.0,)):
    return spark.createDataFrame([row], schema).select(expr.alias("v")).collect()[0].v


def test_degree_days(spark):
    df = spark.createDataFrame([(10.0,), (25.0,), (20.0,)], "t double")
    hdd, cdd = ph.degree_days("t")
    got = [(r[0], r[1]) for r in df.select(hdd, cdd).collect()]
    assert got == [(round(8 / 24, 4), 0.0), (0.0, 0.125), (0.0, 0.0)]


def test_temperature_adjustment(spark):
    df = spark.createDataFrame([(5.0,), (30.0,), (18.0,)], "t double")
    got = [r[0] for r in df.select(ph.temperature_adjustment("t")).collect()]
    assert got == pytest.approx([3.5, 2.24, 0.0])


def test_expected_load_clipped(spark):
    v = one(spark, ph.expected_load(F.lit(10), F.lit(1.0), F.lit(1.18), F.lit(-10.0)))
    raw = 22 * 1.0 * 1.0 * 1.18 + (15 - (-10)) * 0.35  # profile[10] = 1.0
    assert v == min(max(round(raw, 3), 5.0), 38.0)
    hot = one(spark, ph.expected_load(F.lit(10), F.lit(1.0), F.lit(1.18), F.lit(70.0)))
    assert hot == 38.0


def test_solar_chain(spark):
    dc = one(spark, ph.solar_dc_kw(F.lit(800.0), F.lit(35.0)))
    assert dc == pytest.approx(0.8 * 35 * (1 - 0.04))
    ac = one(spark, ph.solar_ac_kw(F.lit(dc)))
    assert ac == pytest.approx(dc * 0.97)


def test_electrical(spark):
    i = one(spark, ph.current_a(F.lit(10.0), F.lit(220.0), F.lit(0.9)))
    assert i == round(10 * 1000 / (220 * 0.9 * math.sqrt(3)), 2)
    assert one(spark, ph.current_a(F.lit(0.0), F.lit(220.0), F.lit(0.9))) == 0.0
    q = one(spark, ph.reactive_kvar(F.lit(10.0), F.lit(0.8)))
    assert q == round(10 * math.tan(math.acos(0.8)), 3)
    assert one(spark, ph.reactive_kvar(F.lit(10.0), F.lit(1.2))) is None


def test_safe_ratio_zero_denominator(spark):
    assert one(spark, ph.safe_ratio(F.lit(5.0), F.lit(0.0))) is None
    assert one(spark, ph.safe_ratio(F.lit(5.0), F.lit(2.0))) == 2.5


def test_battery_voltage(spark):
    assert one(spark, ph.battery_voltage(F.lit(60.0))) == 49.0


def test_climatology_shapes(spark):
    night = one(spark, ph.irradiance_climatology(F.lit(6), F.lit(2), F.lit(0.0)))
    assert night == 0.0
    noon = one(spark, ph.irradiance_climatology(F.lit(6), F.lit(12), F.lit(0.0)))
    assert 300 < noon <= 320
    t = one(spark, ph.temperature_climatology(F.lit(7), F.lit(196), F.lit(14)))
    assert t == pytest.approx(24.3 + 1.5 * math.sin((196 - 15) * 2 * math.pi / 365) + 4.0)


def test_rounding_ties_on_binary_value(spark):
    # 18.93 / 24 is 0.78874999.. in binary: rounds down, like SQL engines do.
    assert one(spark, rnd(F.lit(18.93) / 24, 4)) == 0.7887
    assert one(spark, rnd(F.lit(0.0625), 3)) == 0.063
    assert one(spark, rnd(F.lit(-2.5), 0)) == -3.0


def test_column_defaults_on_load(spark):
    import datetime as dt

    from meterframe import config as C
    from meterframe import schemas
    from meterframe.sources import io

    df = spark.createDataFrame([(1, dt.datetime(2025, 1, 1), 5.0, 5.0, None)],
                               "meter_id int, ts timestamp_ntz, active_power_kw double, energy_kwh double, voltage_v double")
    out = io.with_column_defaults(df, C.MEASUREMENT_DEFAULTS, schemas.MEASUREMENTS).collect()[0]
    assert out.power_factor == 0.92 and out.reactive_power_kvar == 0.0 and out.quality_flag == 1
    assert out.voltage_v is None  # explicit NULL is kept

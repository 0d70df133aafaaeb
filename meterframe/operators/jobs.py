"""Batch build jobs: baseline (G1), daily KPIs (G2), running totals (G3, G4),
energy from power (G5), change sets (B14) and cascading deletes (B15).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import calendar as cal
from ..functions import physics as ph
from ..functions.rounding import rnd


def running_sum(
    df: DataFrame,
    value,
    key: str,
    order: str = "ts",
    out: str = "running",
    chunk=None,
) -> DataFrame:
    """Running sum of ``value`` per ``key`` in ``order``, split into chunks.

    A plain ``sum over (partition by key order by ts)`` puts the whole history
    of one key into one task, so a key holding a large share of the rows would
    become a straggler.  Instead the series is cut into chunks (calendar
    months of ``order`` by default):

    1. per (key, chunk) total -- a partial/final aggregate, tiny output;
    2. offset of each chunk = sum of earlier chunk totals -- a window over the
       chunk totals (a dozen rows per key and year);
    3. running sum inside (key, chunk) plus the chunk offset.

    Each task holds one key's chunk at most; the result equals the plain
    running sum (exactly so for integral values).
    """
    v = cal.col(value)
    chunk = chunk if chunk is not None else F.date_trunc("month", F.col(order)).cast("timestamp_ntz")
    base = df.withColumn("_v", v).withColumn("_chunk", chunk)
    totals = base.groupBy(key, "_chunk").agg(F.sum("_v").alias("_tot"))
    wc = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col(key).alias("_okey"), F.col("_chunk").alias("_ochunk"), F.sum("_tot").over(wc).alias("_off"))
    wi = Window.partitionBy(key, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    inner = base.withColumn("_in", F.sum("_v").over(wi))
    # Null-safe: readings without a key or a time are a series of their own, none is lost.
    same = F.col(key).eqNullSafe(F.col("_okey")) & F.col("_chunk").eqNullSafe(F.col("_ochunk"))
    return inner.join(offsets, same, "left").withColumn(out, plus("_off", "_in")).drop("_v", "_chunk", "_in", "_off", "_okey", "_ochunk")


def plus(a, b):
    """The sum of what is there, as SUM gives it: NULL only if both are."""
    a, b = cal.col(a), cal.col(b)
    return F.coalesce(a + b, a, b)


def chunk_totals(df: DataFrame, value, key: str, order: str = "ts") -> DataFrame:
    """Totals (key, chunk, total) of each calendar month of a series: what a
    later load needs to know of this one."""
    chunk = F.date_trunc("month", F.col(order)).cast("timestamp_ntz")
    return df.groupBy(key, chunk.alias("chunk")).agg(F.sum(cal.col(value)).alias("total"))


def resumed_sum(df: DataFrame, stored: DataFrame, value, key: str, order: str = "ts", out: str = "running") -> DataFrame:
    """Running sum of newly loaded rows that goes on from earlier loads.

    ``stored`` holds the earlier loads' ``chunk_totals`` (several rows for a
    chunk add up).  A row's sum is that of the stored chunks before its month,
    of the stored part of its own month, and of the new rows up to it; so no row
    of an earlier load is read again.  Loads come in time order of each key: a
    stored row of the same month counts as earlier than the new ones.  Rows
    without a time are a month of their own, before all others.
    """
    chunk = F.date_trunc("month", F.col(order)).cast("timestamp_ntz")
    new = df.withColumn("_v", cal.col(value)).withColumn("_chunk", chunk)
    none = F.lit(None).cast("double")
    own = new.groupBy(key, "_chunk").agg(F.sum("_v").alias("_tot")).withColumn("_old", none)
    old = stored.groupBy(key, F.col("chunk").alias("_chunk")).agg(F.sum("total").alias("_old")).withColumn("_tot", none)
    months = own.unionByName(old).groupBy(key, "_chunk").agg(F.sum("_tot").alias("_tot"), F.sum("_old").alias("_old"))
    before = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offset = plus(F.sum(plus("_tot", "_old")).over(before), "_old")
    offsets = months.select(F.col(key).alias("_okey"), F.col("_chunk").alias("_ochunk"), offset.alias("_off"))
    inside = Window.partitionBy(key, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    same = F.col(key).eqNullSafe(F.col("_okey")) & F.col("_chunk").eqNullSafe(F.col("_ochunk"))
    summed = new.withColumn("_in", F.sum("_v").over(inside)).join(offsets, same, "left")
    return summed.withColumn(out, plus("_off", "_in")).drop("_v", "_chunk", "_in", "_off", "_okey", "_ochunk")


def resumed_totalizer(measurements: DataFrame, stored: DataFrame) -> DataFrame:
    """G3 over a new load: its rows with their running energy, round 3."""
    return resumed_sum(measurements, stored, "energy_kwh", "meter_id", out="cumulative_kwh").withColumn("cumulative_kwh", rnd("cumulative_kwh", 3))


def discharged(capacity_kwh: float = C.BATTERY_CAPACITY_KWH):
    """A battery row's share of a full cycle."""
    return F.when(F.col("mode") == "discharging", F.abs("power_kw") / F.lit(capacity_kwh)).otherwise(F.lit(0.0))


def resumed_cycles(battery: DataFrame, stored: DataFrame, capacity_kwh: float = C.BATTERY_CAPACITY_KWH) -> DataFrame:
    """G4 over a new load: its rows with their cycle count, round 4."""
    rows = battery.select("object_id", "ts", "mode", "power_kw")
    return resumed_sum(rows, stored, discharged(capacity_kwh), "object_id", out="cycle_count").withColumn("cycle_count", rnd("cycle_count", 4)).drop("power_kw")


def cumulative_totalizer(measurements: DataFrame) -> DataFrame:
    """Running energy per meter in time order, round 3."""
    return running_sum(measurements, "energy_kwh", "meter_id", out="cumulative_kwh").withColumn(
        "cumulative_kwh", rnd("cumulative_kwh", 3)
    )


def battery_cycles(battery: DataFrame, capacity_kwh: float = C.BATTERY_CAPACITY_KWH) -> DataFrame:
    """Equivalent full cycles: running sum of |discharge| / capacity, round 4."""
    return with_cycle_count(battery.select("object_id", "ts", "mode", "power_kw"), capacity_kwh).drop("power_kw")


def with_cycle_count(battery: DataFrame, capacity_kwh: float = C.BATTERY_CAPACITY_KWH) -> DataFrame:
    """Battery rows with their running ``cycle_count``."""
    return running_sum(battery, discharged(capacity_kwh), "object_id", out="cycle_count").withColumn("cycle_count", rnd("cycle_count", 4))


def energy_from_power(measurements: DataFrame, interval_hours: float = 1.0) -> DataFrame:
    """kWh from kW for fixed-length intervals."""
    return measurements.select(
        "meter_id", "ts", "active_power_kw", rnd(ph.energy_from_power("active_power_kw", interval_hours), 6).alias("energy_from_power_kwh")
    )


def build_baseline(t, tz: str = C.REPORT_TIMEZONE) -> DataFrame:
    """Hourly baseline per (site, local month, local hour, day type) (G1).

    Main readings are paired with the site's weather of the same hour.  Mean
    and population std are rounded to 4 places, the least-squares slope of
    energy on temperature to 6; the slope is 0.0 for one sample or constant
    temperature.  All aggregates are partial/final, so hot keys are merged
    map-side.
    """
    from .views import level_1_consumption

    l1 = level_1_consumption(t.measurements_nocum, t.meters, tz)
    return baseline_from(l1, t.weather)


def with_hourly(rows: DataFrame, weather: DataFrame, *columns: str, how: str = "inner") -> DataFrame:
    """Rows with weather columns of their site's hour.

    The weather holds every hour of every site, but its planned size is that of
    the site ids it is made from, so without a hint it would be broadcast and
    pass whole through the driver: both sides are sorted and merged instead."""
    return rows.join(weather.select("object_id", "ts", *columns).hint("merge"), ["object_id", "ts"], how)


def baseline_from(l1: DataFrame, weather: DataFrame) -> DataFrame:
    j = with_hourly(l1.select("object_id", "ts", "month", "hour", "day_type", "energy_kwh"), weather, "temperature_c")
    slope = F.when(
        (F.count(F.lit(1)) > 1) & (F.max("temperature_c") > F.min("temperature_c")),
        F.regr_slope("energy_kwh", "temperature_c"),
    ).otherwise(F.lit(0.0))
    return j.groupBy(
        "object_id", "month", F.col("hour").alias("hour_of_day"), "day_type"
    ).agg(
        rnd(F.avg("energy_kwh"), 4).alias("expected_kwh"),
        rnd(F.stddev_pop("energy_kwh"), 4).alias("std_dev_kwh"),
        rnd(slope, 6).alias("temperature_coeff"),
        F.count(F.lit(1)).cast("int").alias("sample_count"),
    )


BASELINE_KEY = ["object_id", "month", "hour_of_day", "day_type"]


def baseline_states(l1: DataFrame, weather: DataFrame) -> DataFrame:
    """Mergeable moments of a load's readings for each baseline key: how many,
    the means of energy and temperature, their sums of squares and of products
    about the means, and the span of temperatures.  The states of several loads
    lie side by side; ``baseline_of`` merges them."""
    j = with_hourly(l1.select("object_id", "ts", "month", "hour", "day_type", "energy_kwh"), weather, "temperature_c")
    paired = F.col("energy_kwh").isNotNull() & F.col("temperature_c").isNotNull()
    e, t = F.when(paired, F.col("energy_kwh")), F.when(paired, F.col("temperature_c"))
    return j.groupBy("object_id", "month", F.col("hour").alias("hour_of_day"), "day_type").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("energy_kwh").alias("n_e"), F.avg("energy_kwh").alias("mean_e"), (F.var_pop("energy_kwh") * F.count("energy_kwh")).alias("m2_e"),
        F.count(e).alias("n_p"), F.avg(e).alias("mean_pe"), F.avg(t).alias("mean_t"),
        (F.var_pop(t) * F.count(t)).alias("m2_t"), (F.covar_pop(e, t) * F.count(e)).alias("c_et"),
        F.min("temperature_c").alias("min_t"), F.max("temperature_c").alias("max_t"),
    )


def baseline_of(states: DataFrame) -> DataFrame:
    """The baseline (G1) of all loads whose states are given.

    Moments about a state's mean are moved to the common mean before they are
    added, so nothing large cancels.  The states of a key are one for each load."""
    key = Window.partitionBy(*BASELINE_KEY)
    mean = lambda m, n: (F.sum(F.col(m) * F.col(n)).over(key) / F.nullif(F.sum(n).over(key), F.lit(0)))
    moved = states.select(
        "*", (F.col("mean_e") - mean("mean_e", "n_e")).alias("d_e"), mean("mean_e", "n_e").alias("all_e"),
        (F.col("mean_pe") - mean("mean_pe", "n_p")).alias("d_pe"), (F.col("mean_t") - mean("mean_t", "n_p")).alias("d_t"),
    )
    rows, n_e = F.sum("rows"), F.sum("n_e")
    m2_t = F.sum(F.col("m2_t") + F.col("n_p") * F.col("d_t") * F.col("d_t"))
    c_et = F.sum(F.col("c_et") + F.col("n_p") * F.col("d_pe") * F.col("d_t"))
    m2_e = F.sum(F.col("m2_e") + F.col("n_e") * F.col("d_e") * F.col("d_e"))
    slope = F.when((rows > 1) & (F.max("max_t") > F.min("min_t")), c_et / F.nullif(m2_t, F.lit(0.0))).otherwise(F.lit(0.0))
    return moved.groupBy(*BASELINE_KEY).agg(
        rnd(F.first("all_e"), 4).alias("expected_kwh"),
        rnd(F.sqrt(m2_e / F.nullif(n_e, F.lit(0))), 4).alias("std_dev_kwh"),
        rnd(slope, 6).alias("temperature_coeff"),
        rows.cast("int").alias("sample_count"),
    )


def daily_metrics(t, tz: str = C.REPORT_TIMEZONE) -> DataFrame:
    """Daily efficiency KPIs per (site, local day).

    Three pre-aggregates on (object_id, day) -- main meter, solar, battery --
    are joined after aggregation, so the joins see one row per site-day.
    """
    from .views import level_1_consumption

    l1 = level_1_consumption(t.measurements_nocum, t.meters, tz)
    return daily_metrics_from(l1, t.solar, t.battery, t.objects, tz)


def daily_metrics_from(l1: DataFrame, solar: DataFrame, battery: DataFrame, objects: DataFrame, tz=C.REPORT_TIMEZONE) -> DataFrame:
    """KPIs from one aggregation: main, solar and battery rows are tagged,
    unioned and aggregated together per (object_id, local day) -- one shuffle
    (with map-side partial aggregation) instead of three aggregates and two
    joins.  Days without main readings are dropped, as in the paired lists;
    solar and battery days without a main reading do not appear."""
    k, e = F.col("_k"), F.col("_e")
    h = F.col("hour")
    is_day = (h >= 7) & (h < 23)
    day = F.to_date(cal.local_ts("ts", tz)).alias("day")
    none = F.lit(None).cast("double")
    main_rows = l1.select(
        "object_id", "day", F.lit(0).alias("_k"), F.col("energy_kwh").alias("_e"), F.col("active_power_kw").alias("_p"),
        F.when(is_day, F.col("energy_kwh") * F.lit(C.DEFAULT_DAY_RATE)).otherwise(F.lit(0.0)).alias("_cd"),
        F.when(~is_day, F.col("energy_kwh") * F.lit(C.DEFAULT_NIGHT_RATE)).otherwise(F.lit(0.0)).alias("_cn"),
        F.lit(None).cast("string").alias("_m"),
    )
    sol_rows = solar.select(
        "object_id", day, F.lit(1).alias("_k"), F.col("energy_kwh").alias("_e"), none.alias("_p"), none.alias("_cd"),
        none.alias("_cn"), F.lit(None).cast("string").alias("_m"),
    )
    bat_rows = battery.select(
        "object_id", day, F.lit(2).alias("_k"), F.col("energy_kwh").alias("_e"), none.alias("_p"), none.alias("_cd"),
        none.alias("_cn"), F.col("mode").alias("_m"),
    )
    zero = F.lit(0.0)
    agg = (
        main_rows.unionByName(sol_rows)
        .unionByName(bat_rows)
        .groupBy("object_id", "day")
        .agg(
            F.count_if(k == 0).alias("_nmain"),
            F.sum(F.when(k == 0, e)).alias("total"),
            F.max(F.when(k == 0, F.col("_p"))).alias("peak"),
            F.avg(F.when(k == 0, F.col("_p"))).alias("avg"),
            F.sum(F.when(k == 0, F.col("_cd"))).alias("cost_day"),
            F.sum(F.when(k == 0, F.col("_cn"))).alias("cost_night"),
            F.coalesce(F.sum(F.when(k == 1, e)), zero).alias("solar"),
            F.coalesce(F.sum(F.when((k == 2) & (F.col("_m") == "charging"), e)), zero).alias("ch"),
            F.coalesce(F.sum(F.when((k == 2) & (F.col("_m") == "discharging"), e)), zero).alias("dis"),
        )
        .filter(F.col("_nmain") > 0)
    )
    j = agg.join(objects.select("object_id", "area_m2"), "object_id")
    total, solar_kwh, peak, avg = F.col("total"), F.col("solar"), F.col("peak"), F.col("avg")
    grid = F.greatest(F.lit(0.0), total - solar_kwh - F.col("dis"))
    return j.select(
        "object_id",
        F.col("day").alias("date"),
        rnd(total, 3).alias("total_consumption_kwh"),
        rnd(solar_kwh, 3).alias("solar_generation_kwh"),
        rnd("ch", 3).alias("battery_charge_kwh"),
        rnd("dis", 3).alias("battery_discharge_kwh"),
        rnd(grid, 3).alias("grid_import_kwh"),
        F.lit(0.0).alias("grid_export_kwh"),
        rnd(total / F.col("area_m2"), 5).alias("specific_consumption_kwh_m2"),
        rnd(peak, 3).alias("peak_demand_kw"),
        rnd(avg, 3).alias("avg_demand_kw"),
        rnd(F.when(peak > 0, avg / F.nullif(peak, F.lit(0.0))).otherwise(F.lit(0.0)), 4).alias("load_factor"),
        rnd(F.when(avg > 0, peak / F.nullif(avg, F.lit(0.0))).otherwise(F.lit(0.0)), 4).alias("peak_to_avg_ratio"),
        rnd(
            F.when(solar_kwh > 0, F.least(solar_kwh, total) / F.nullif(solar_kwh, F.lit(0.0))).otherwise(F.lit(0.0)), 4
        ).alias("self_consumption_ratio"),
        rnd(F.col("cost_day") + F.col("cost_night"), 2).alias("cost_uah"),
        rnd("cost_day", 2).alias("cost_day_uah"),
        rnd("cost_night", 2).alias("cost_night_uah"),
        rnd(grid * F.lit(C.CO2_KG_PER_KWH), 3).alias("co2_kg"),
    )


def apply_changes(base: DataFrame, changes: DataFrame, key: list[str], op_col: str = "op", ts: str = "ts", check: bool = True) -> DataFrame:
    """Apply a batch change set.

    ``changes`` has the base columns plus ``op`` in {'I','U','D'}, one row per
    key.  A change that cannot apply is an error (``change_violations``; skip
    the check with ``check=False``).  Only months of ``ts`` that the changes
    touch are joined: their rows without a change stay (left anti join on the
    key), and the inserted and updated rows are added; all other months pass
    through.  The months are one number each, read from the change set.
    ``sources.months.MonthTable`` writes such changes back.
    """
    touched = in_months(changes, ts) if ts in key else None
    if check and (bad := change_violations(base, changes, key, op_col, ts, touched).take(5)):
        raise ValueError(f"changes that cannot apply: {[tuple(r) for r in bad]}")
    columns = base.columns
    fresh = changes.filter(F.col(op_col).isin("I", "U")).select(*columns)
    if ts not in key:
        return base.join(changes.select(*key), key, "left_anti").select(*columns).unionByName(fresh)
    kept = base.filter(touched).join(changes.select(*key), key, "left_anti").select(*columns)
    return base.filter(~touched).unionByName(kept).unionByName(fresh)


def in_months(changes: DataFrame, ts: str = "ts"):
    """Whether a row's month is one that the changes touch (or it has none)."""
    month = F.year(ts) * 100 + F.month(ts)
    return F.coalesce(month.isin([r[0] for r in changes.select(month).distinct().collect()]), F.lit(True))


def change_violations(base: DataFrame, changes: DataFrame, key: list[str], op_col: str = "op", ts: str = "ts", touched=None) -> DataFrame:
    """Changes that cannot apply, with a reason: an update or delete of a
    missing key, an insert of an existing one, several changes of one key, or
    an unknown operation.  Of the base only the touched months are read (where
    ``ts`` is part of the key; ``touched`` gives their condition if it is known
    already), and only rows of changed keys go further."""
    op = F.col(op_col)
    counted = changes.groupBy(*key).agg(F.count("*").alias("_n"), F.min(op_col).alias(op_col), F.max(op_col).alias("_max"))
    near = base.filter(in_months(changes, ts) if touched is None else touched) if ts in key else base
    changed = changes.select(*(F.col(k).alias(f"_{k}") for k in key)).distinct()
    same = [F.col(k) == F.col(f"_{k}") for k in key]
    known = near.select(*key).join(changed, same, "left_semi").distinct().withColumn("_exists", F.lit(True))
    j = counted.join(known, key, "left")
    reason = (
        F.when(F.col("_n") > 1, F.lit("repeated key"))
        .when(~op.isin("I", "U", "D") | op.isNull(), F.lit("unknown operation"))
        .when(op.isin("U", "D") & F.col("_exists").isNull(), F.lit("missing key"))
        .when((op == "I") & F.col("_exists").isNotNull(), F.lit("existing key"))
    )
    return j.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select(*key, op_col, "reason")


def cascade_delete(tables: dict[str, DataFrame], object_ids: DataFrame) -> dict[str, DataFrame]:
    """Remove sites and everything that references them.

    ``object_ids`` is a one-column DataFrame of deleted ``object_id``.  Meters
    go by object, readings by their meter, site-keyed facts by object; each is
    a left-anti join, so the deleted-key set can be arbitrarily large.
    """
    gone = object_ids.select("object_id").distinct()
    out = dict(tables)
    out["objects"] = tables["objects"].join(gone, "object_id", "left_anti")
    gone_meters = tables["meters"].join(gone, "object_id", "left_semi").select("meter_id")
    out["meters"] = tables["meters"].join(gone, "object_id", "left_anti")
    out["measurements"] = tables["measurements"].join(gone_meters, "meter_id", "left_anti")
    for name in ("baseline_consumption", "energy_efficiency_metrics", "weather_data", "solar_generation", "battery_state"):
        if name in tables:
            out[name] = tables[name].join(gone, "object_id", "left_anti")
    return out

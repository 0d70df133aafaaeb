"""Data-quality operators: the database constraints re-aimed as checks.

Spark does not enforce CHECK / UNIQUE / FOREIGN KEY / NOT NULL / enum
constraints, so each becomes a distributed count.  As in SQL, a CHECK passes
on NULL: a violation is ``NOT coalesce(cond, true)``.  Every rule is counted
in one pass over its table (conditional counts), then unpivoted with
``stack`` to (table, rule, violations) rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import config as C

c = F.col


def violated(cond: Column) -> Column:
    return ~F.coalesce(cond, F.lit(True))


def checks() -> dict[str, list[tuple[str, Column]]]:
    """(rule name, condition that must hold) per table; built on call (needs a session)."""
    return {
        "objects": [
            ("ck_min_le_avg", c("min_load_kw") <= c("avg_load_kw")),
            ("ck_avg_le_max", c("avg_load_kw") <= c("max_load_kw")),
            ("ck_area_positive", c("area_m2") > 0),
        ],
        "meters": [("ck_meter_level", c("level").isin(*C.METER_LEVELS))],
        "measurements": [
            ("ck_power_non_negative", c("active_power_kw") >= 0),
            ("ck_pf_range", c("power_factor").between(0, 1)),
            ("ck_quality_flag", c("quality_flag").isin(*C.QUALITY_FLAGS)),
        ],
        "weather_data": [
            ("ck_humidity", c("humidity_pct").between(0, 100)),
            ("ck_cloud_cover", c("cloud_cover_pct").between(0, 100)),
            ("ck_irradiance", c("solar_irradiance_wm2") >= 0),
        ],
        "tariff_zones": [("ck_rate_positive", c("rate_uah_kwh") > 0)],
        "baseline_consumption": [
            ("ck_month", c("month").between(1, 12)),
            ("ck_hour", c("hour_of_day").between(0, 23)),
            ("ck_expected_positive", c("expected_kwh") >= 0),
        ],
        "solar_generation": [
            ("ck_solar_power", c("power_kw") >= 0),
            ("ck_solar_energy", c("energy_kwh") >= 0),
            ("ck_irradiance2", c("irradiance_wm2") >= 0),
        ],
    }


def battery_checks() -> list[tuple[str, Column]]:
    return [
        ("ck_soc_range", c("soc_pct").between(0, 100)),
        ("ck_health_range", c("health_pct").between(0, 100)),
    ]


NOT_NULL = {
    "objects": ["object_id", "name", "type", "location", "area_m2", "max_power_kw", "meter_count", "operation_mode",
                "avg_load_kw", "min_load_kw", "max_load_kw"],
    "meters": ["meter_id", "object_id", "name", "type", "level", "is_active"],
    "measurements": ["meter_id", "ts", "active_power_kw", "energy_kwh"],
    "weather_data": ["ts", "temperature_c", "solar_irradiance_wm2", "hdd", "cdd"],
    "tariff_zones": ["name", "tariff_name", "zone_type", "start_sec", "end_sec", "rate_uah_kwh"],
    "baseline_consumption": ["object_id", "month", "hour_of_day", "day_type", "expected_kwh"],
    "energy_efficiency_metrics": ["object_id", "date", "total_consumption_kwh", "specific_consumption_kwh_m2"],
    "solar_generation": ["ts", "power_kw", "energy_kwh", "irradiance_wm2"],
    "battery_state": ["ts", "soc_pct", "soc_kwh", "power_kw", "energy_kwh", "mode"],
}

ENUMS = {
    ("objects", "type"): C.OBJECT_TYPES,
    ("meters", "type"): C.METER_TYPES,
    ("tariff_zones", "zone_type"): C.TARIFF_ZONE_TYPES,
    ("baseline_consumption", "day_type"): C.DAY_TYPES,
    ("battery_state", "mode"): C.BATTERY_MODES,
}


def _counts(df: DataFrame, table: str, rules: list[tuple[str, Column]], kind: str = "rule") -> DataFrame:
    """One aggregation pass: a violation count per rule, unpivoted to rows."""
    aggs = [F.count_if(violated(cond)).alias(f"_{i}") for i, (_, cond) in enumerate(rules)]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{name}', _{i}" for i, (name, _) in enumerate(rules))
    return wide.select(
        F.lit(table).alias("table_name"), F.expr(f"stack({len(rules)}, {pairs}) as ({kind}, violations)")
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def check_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rule, violations) for every CHECK constraint (L1)."""
    return _union([_counts(tables[t], t, rules) for t, rules in checks().items() if t in tables])


def check_battery(battery: DataFrame) -> DataFrame:
    """Battery state-of-charge and health ranges (L2)."""
    return _counts(battery, "battery_state", battery_checks())


def duplicate_keys(tables: dict[str, DataFrame], keys: dict[str, list[str]]) -> DataFrame:
    """Per table: number of natural keys seen more than once, and rows involved (L3).

    A grouped count (partial/final aggregate) followed by a global sum.
    """
    parts = []
    for t, key in keys.items():
        if t not in tables:
            continue
        g = tables[t].groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
        parts.append(
            g.agg(
                F.count(F.lit(1)).alias("duplicate_keys"),
                F.coalesce(F.sum("_n"), F.lit(0)).alias("duplicate_rows"),
            ).select(F.lit(t).alias("table_name"), "duplicate_keys", "duplicate_rows")
        )
    return _union(parts)


def orphans(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows whose foreign key has no parent (L4): left-anti joins, then counts."""
    rel = [
        ("meters.object_id", "meters", "objects", "object_id"),
        ("measurements.meter_id", "measurements", "meters", "meter_id"),
        ("baseline_consumption.object_id", "baseline_consumption", "objects", "object_id"),
        ("energy_efficiency_metrics.object_id", "energy_efficiency_metrics", "objects", "object_id"),
    ]
    parts = []
    for name, child, parent, key in rel:
        if child in tables and parent in tables:
            o = tables[child].join(tables[parent].select(key).distinct(), key, "left_anti")
            parts.append(o.agg(F.count(F.lit(1)).alias("orphans")).select(F.lit(name).alias("relation"), "orphans"))
    return _union(parts)


def null_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column, violations) for NOT NULL columns."""
    parts = []
    for t, cols in NOT_NULL.items():
        if t in tables:
            parts.append(_counts(tables[t], t, [(col, F.col(col).isNotNull()) for col in cols], kind="column_name"))
    return _union(parts)


def enum_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column, violations) for values outside an enumeration."""
    parts = []
    for (t, col), allowed in ENUMS.items():
        if t in tables:
            parts.append(_counts(tables[t], t, [(col, F.col(col).isin(*allowed))], kind="column_name"))
    return _union(parts)


def rules_of(table: str) -> list[tuple[str, str, Column]]:
    """(kind, name, condition) of all that is asked of a table's rows."""
    out = [("check", name, cond) for name, cond in checks().get(table, [])]
    out += [("not null", col, F.col(col).isNotNull()) for col in NOT_NULL.get(table, [])]
    out += [("allowed value", col, F.col(col).isin(*allowed)) for (t, col), allowed in ENUMS.items() if t == table]
    return out


def observed_load(df: DataFrame, table: str, write) -> DataFrame:
    """Load rows with ``write(df)`` and count the violations of the table's
    rules on the way: (table_name, kind, rule, violations, rows).

    The counts are observed metrics of the one job that writes, so the rows are
    read once; they describe what was loaded, and no row is held back
    (``quarantine_split`` does that).  Spark may run a lost task's part of an
    observation again; a count taken after the load (``check_violations``) is
    exact in any case.
    """
    rules = rules_of(table)
    seen = Observation(f"load of {table}")
    write(df.observe(seen, F.count(F.lit(1)).alias("rows"), *(F.count_if(violated(cond)).alias(f"r{i}") for i, (_, _, cond) in enumerate(rules))))
    got = seen.get
    found = [(table, kind, name, int(got[f"r{i}"]), int(got["rows"])) for i, (kind, name, _) in enumerate(rules)]
    return df.sparkSession.createDataFrame(found, "table_name string, kind string, rule string, violations long, rows long")


def quarantine_split(measurements: DataFrame, meters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split readings into (clean, quarantined); quarantined rows carry reasons.

    Reasons: NULL or negative power, power factor outside [0, 1], unknown
    quality flag, flag -1 (bad), unknown meter.  The meter check is a left
    join to the meter dimension.
    """
    known = meters.select("meter_id").distinct().withColumn("_known", F.lit(True))
    m = measurements.join(known, "meter_id", "left")
    p, pf, q = F.col("active_power_kw"), F.col("power_factor"), F.col("quality_flag")
    reasons = F.concat_ws(
        ",",
        F.when(p.isNull(), F.lit("null_power")),
        F.when(p < 0, F.lit("negative_power")),
        F.when(~pf.between(0, 1), F.lit("pf_range")),
        F.when(~q.isin(*C.QUALITY_FLAGS), F.lit("quality_flag")),
        F.when(q == -1, F.lit("flagged_bad")),
        F.when(F.col("_known").isNull(), F.lit("unknown_meter")),
    )
    m = m.withColumn("reasons", reasons).drop("_known")
    return m.filter(F.col("reasons") == "").drop("reasons"), m.filter(F.col("reasons") != "")

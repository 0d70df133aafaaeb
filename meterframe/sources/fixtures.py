"""Metering tables derived from the driver's test tables.

Every metering table is a deterministic Spark derivation of ``lineitem`` (and
``supplier`` for the site list), folded into calendar year 2025 UTC so that
both DST changes and the year edge occur:

* a line item is one raw reading: site ``1 + l_suppkey // per_site`` (a few
  suppliers each, so sites grow with the data), meter
  slot ``2 + l_partkey % 5`` (2-4 zones, 5 solar, 6 battery) and an hour
  derived from ``l_shipdate`` and ``l_orderkey``;
* per (site, slot, hour) the readings are summed (energy) and maxed (power);
  the main meter (slot 1) sums its sub-meters;
* weather is a per-site feed for every hour of the year.

Suppliers per site is a parameter, so benchmarks can spread the same rows over
more or fewer sites (assets).
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions import calendar as cal
from ..functions import physics as ph
from ..functions import tariffs as tf
from ..functions.rounding import rnd
from .buckets import site_hours, write_site_hours
from .io import scratch_path

EPOCH_DATE = dt.date(1992, 1, 1)
YEAR_START = dt.datetime(2025, 1, 1)
SUPPLIERS_PER_SITE = 4
HOURS = 8760


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def site_of(suppkey: str, per_site: int):
    return (1 + F.floor(F.col(suppkey) / per_site)).cast("int")


def raw_readings(lineitem: DataFrame, per_site: int = SUPPLIERS_PER_SITE) -> DataFrame:
    """One raw reading per line item: object_id, slot, ts and the source fields."""
    hours = (
        F.pmod(F.datediff(F.to_date("l_shipdate"), F.lit(EPOCH_DATE)), F.lit(365)) * 24
        + F.col("l_orderkey") % 24
    ).cast("int")
    return lineitem.select(
        site_of("l_suppkey", per_site).alias("object_id"),
        (2 + F.col("l_partkey") % 5).cast("int").alias("slot"),
        F.timestamp_add("HOUR", hours, F.to_timestamp_ntz(F.lit(YEAR_START.isoformat(sep=" ")))).alias("ts"),
        "l_quantity",
        "l_linenumber",
        "l_orderkey",
    )


# Partitions of site hours for each split of the line items, so that a task's
# share of them does not grow with the input; an input of few splits is small.
PARTS_PER_SPLIT, FEW_SPLITS = 16, 4


def by_site_hour(raw: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Raw readings with those of a site's hour in one partition.

    Grouping them takes many times their shuffled bytes of memory, so adaptive
    execution, which goes by those bytes, would make partitions too large: their
    number follows the line items' splits instead.
    """
    splits = lineitem.rdd.getNumPartitions()
    if splits <= FEW_SPLITS:
        return raw.repartition("object_id", "ts")
    return raw.repartition(max(int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions")), PARTS_PER_SPLIT * splits), "object_id", "ts")


def sub_readings(raw: DataFrame) -> DataFrame:
    """Per (object, slot, hour): energy = sum, power = max, plus battery fields."""
    return raw.groupBy("object_id", "slot", "ts").agg(
        F.sum("l_quantity").alias("energy_kwh"),
        F.max("l_quantity").alias("active_power_kw"),
        F.sum(
            F.when(F.col("l_linenumber") % 3 == 0, -F.col("l_quantity"))
            .when(F.col("l_linenumber") % 3 == 1, F.col("l_quantity"))
            .otherwise(F.lit(0.0))
        ).alias("battery_power_kw"),
        F.max("l_orderkey").alias("max_orderkey"),
    )


def main_readings(sub: DataFrame) -> DataFrame:
    """Main meter (slot 1) per (object, hour): sum of the sub-meters."""
    return sub.groupBy("object_id", "ts").agg(
        F.sum("energy_kwh").alias("energy_kwh"),
        F.sum("active_power_kw").alias("active_power_kw"),
    ).withColumn("slot", F.lit(1))


def meter_id(object_id="object_id", slot="slot"):
    return ((cal.col(object_id) - 1) * C.METERS_PER_SITE + cal.col(slot)).cast("int")


def with_electrical(df: DataFrame) -> DataFrame:
    """Add power factor, voltage, current, reactive power and quality flag."""
    h = F.hour("ts")
    pf = (F.lit(0.80).cast("decimal(3,2)") + (h % 20) * F.lit(0.01).cast("decimal(3,2)")).cast("double")
    return (
        df.withColumn("power_factor", pf)
        .withColumn("voltage_v", (210 + (h * 3) % 26).cast("double"))
        .withColumn("quality_flag", F.lit(1).cast("short"))
        .withColumn("reactive_power_kvar", ph.reactive_kvar("active_power_kw", "power_factor"))
        .withColumn("current_a", ph.current_a("active_power_kw", "voltage_v", "power_factor"))
    )


def deal(ids: DataFrame) -> DataFrame:
    """Site ids over as many tasks as the session shuffles to."""
    return ids.repartition(int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions")), "object_id")


def weather_hours(objects: DataFrame) -> DataFrame:
    """(object_id, ts) for every hour of the year and every site.

    The ids are few bytes, which adaptive execution puts into one partition, and
    each makes 8,760 rows: ``deal`` spreads them by number, which it leaves
    alone, so that all tasks make hours, and a site's hours lie together.
    """
    first, last = YEAR_START, YEAR_START + dt.timedelta(hours=HOURS - 1)
    bound = lambda t: F.to_timestamp_ntz(F.lit(t.isoformat(sep=" ")))
    return deal(objects.select("object_id")).select("object_id", F.explode(F.sequence(bound(first), bound(last), F.expr("INTERVAL 1 HOUR"))).alias("ts"))


def weather_from_hours(hours: DataFrame, tz: str = C.REPORT_TIMEZONE) -> DataFrame:
    """Deterministic per-site weather for the given (object_id, ts) hours."""
    full = with_weather(hours.select("object_id", "ts"), tz)
    return full.select(
        "object_id", "ts", "temperature_c", "humidity_pct", "wind_speed_ms", "solar_irradiance_wm2",
        "cloud_cover_pct", "precipitation_mm", "hdd", "cdd", "data_source", "_gap",
    )


def with_weather(rows: DataFrame, tz: str = C.REPORT_TIMEZONE) -> DataFrame:
    """The weather of each row's hour, as columns."""
    lt = cal.local_ts("ts", tz)
    base = rows.select(
        "*",
        F.month(lt).alias("_m"),
        F.dayofyear(lt).alias("_doy"),
        F.hour(lt).alias("_h"),
    )
    wobble = ((F.col("_doy") * 7 + F.col("_h") * 13) % 17 - 8).cast("decimal(10,1)") * F.lit(0.2).cast(
        "decimal(2,1)"
    )
    temp = rnd(ph.temperature_climatology("_m", "_doy", "_h") + wobble.cast("double"), 2)
    cloud = ((F.col("_doy") * 31 + F.col("_h") * 7) % 101).cast("double")
    hdd, cdd = ph.degree_days("temperature_c")
    return (
        base.withColumn("temperature_c", temp)
        .withColumn("cloud_cover_pct", cloud)
        .withColumn("humidity_pct", (40 + (F.col("_doy") * 13 + F.col("_h") * 5) % 50).cast("double"))
        .withColumn("wind_speed_ms", ((F.col("_doy") * 3 + F.col("_h")) % 11).cast("double") / 2)
        .withColumn("solar_irradiance_wm2", rnd(ph.irradiance_climatology("_m", "_h", "cloud_cover_pct"), 2))
        .withColumn("precipitation_mm", F.lit(0.0))
        .withColumn("hdd", hdd)
        .withColumn("cdd", cdd)
        .withColumn("data_source", F.lit("fixture"))
        .withColumn("_gap", (F.col("_doy") + F.col("_h")) % 11 == 5)
    )


class MeterTables:
    """Lazily built metering tables over one test-data directory.

    Every attribute is a DataFrame (a logical plan); nothing is computed until
    an action runs.  ``per_site`` suppliers make up a site.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, per_site: int = SUPPLIERS_PER_SITE, tz: str = C.REPORT_TIMEZONE):
        self.spark = spark
        self.sf_dir = sf_dir
        self.per_site = per_site
        self.tz = tz

    # -- inputs -------------------------------------------------------------
    @cached_property
    def lineitem(self) -> DataFrame:
        return read_table(self.spark, self.sf_dir, "lineitem")

    @cached_property
    def raw(self) -> DataFrame:
        return raw_readings(self.lineitem, self.per_site)

    @cached_property
    def sub(self) -> DataFrame:
        return sub_readings(by_site_hour(self.raw, self.lineitem))

    @cached_property
    def main(self) -> DataFrame:
        return main_readings(self.sub)

    # -- dimensions ---------------------------------------------------------
    @cached_property
    def supplier_sites(self) -> DataFrame:
        """The site id of each supplier."""
        return read_table(self.spark, self.sf_dir, "supplier").select(site_of("s_suppkey", self.per_site).alias("object_id"))

    @cached_property
    def weather_sites(self) -> DataFrame:
        """The site ids, dealt before they are made distinct: dealing them again
        after that by the same column would be planned away."""
        return deal(self.supplier_sites).distinct()

    @cached_property
    def objects(self) -> DataFrame:
        """Sites: the distinct site ids of the supplier table, attributes by rule."""
        ids = self.supplier_sites.distinct()
        areas = F.array(*[F.lit(a) for a in C.SITE_AREAS_M2])
        return ids.select(
            "object_id",
            F.format_string("Site %d", "object_id").alias("name"),
            F.lit("polyclinic").alias("type"),
            F.lit("Kyiv").alias("location"),
            F.element_at(areas, (F.col("object_id") - 1) % len(C.SITE_AREAS_M2) + 1).alias("area_m2"),
            F.lit(95.0).alias("max_power_kw"),
            F.lit(C.METERS_PER_SITE).cast("short").alias("meter_count"),
            F.lit("8-20").alias("operation_mode"),
            F.lit(C.AVG_LOAD_KW).alias("avg_load_kw"),
            F.lit(C.MIN_LOAD_KW).alias("min_load_kw"),
            F.lit(C.MAX_LOAD_KW).alias("max_load_kw"),
        )

    @cached_property
    def meters(self) -> DataFrame:
        """Six meters per site (main, three zones, solar, battery)."""
        slot_type = T.StructType(
            [
                T.StructField("slot", T.IntegerType()),
                T.StructField("name", T.StringType()),
                T.StructField("type", T.StringType()),
                T.StructField("level", T.ShortType()),
                T.StructField("location", T.StringType()),
            ]
        )
        slots = F.array(
            *[
                F.struct(
                    F.lit(s).alias("slot"), F.lit(n).alias("name"), F.lit(t).alias("type"),
                    F.lit(lv).cast("short").alias("level"), F.lit(loc).alias("location"),
                ).cast(slot_type)
                for s, n, t, lv, loc in C.METER_SLOTS
            ]
        )
        return (
            self.objects.select("object_id", F.inline(slots))
            .select(
                meter_id("object_id", "slot").alias("meter_id"),
                "object_id",
                "name",
                "type",
                "level",
                "location",
                F.format_string("SN-%04d-2025", meter_id("object_id", "slot")).alias("serial_number"),
                F.lit(True).alias("is_active"),
                F.to_timestamp_ntz(F.lit("2024-12-01 00:00:00")).alias("installed_at"),
                "slot",
            )
        )

    @cached_property
    def tariff_zones(self) -> DataFrame:
        return tf.tariff_zones(self.spark)

    @cached_property
    def tariff_versions(self) -> DataFrame:
        """Versions of both zones for every site: a rate for each quarter that
        begins at the site's own hour and has its own step, a campaign in May
        that overlaps, an inactive version, and no version at all in November."""
        quarters = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(f"2025-{m:02d}-01").cast("timestamp_ntz").alias("first"), F.lit(last).cast("timestamp_ntz").alias("last"))
                             for n, (m, last) in enumerate(((1, "2025-04-01"), (4, "2025-07-01"), (7, "2025-11-01"), (12, None)))])
        late = F.make_interval(hours=F.col("object_id") % 30)
        base = self.objects.select("object_id", late.alias("late"), F.inline(quarters)).crossJoin(F.broadcast(self.tariff_zones.drop("valid_from", "valid_to", "is_active")))
        step = (F.col("n") * 10 + F.col("object_id") % 7) / 100
        usual = base.select(
            "object_id", "zone_id", "zone_type", "start_sec", "end_sec", (F.col("rate_uah_kwh") + step).alias("rate_uah_kwh"), F.lit(True).alias("is_active"),
            F.when(F.col("n") > 0, F.col("first") + F.col("late")).alias("valid_from"), (F.col("last") + F.col("late")).alias("valid_to"),
        )
        special = lambda rate, active, frm, to: self.objects.select(
            "object_id", F.lit(1).alias("zone_id"), F.lit("day").alias("zone_type"), F.lit(36000).alias("start_sec"), F.lit(64800).alias("end_sec"),
            F.lit(rate).alias("rate_uah_kwh"), F.lit(active).alias("is_active"), F.lit(frm).cast("timestamp_ntz").alias("valid_from"), F.lit(to).cast("timestamp_ntz").alias("valid_to"),
        )
        return usual.unionByName(special(3.5, True, "2025-05-10 05:30:00", "2025-05-20")).unionByName(special(0.1, False, "2025-06-01", "2025-06-30"))

    # -- facts --------------------------------------------------------------
    @cached_property
    def readings(self) -> DataFrame:
        """All meters' hourly readings with object_id and slot (before enrichment).

        One scan and one exchange on (object_id, ts) serve both the sub-meters
        and the main meter that sums them; an hour of a site has few rows.
        """
        hours = by_site_hour(self.raw, self.lineitem).groupBy("object_id", "ts", "slot").agg(
            F.sum("l_quantity").alias("energy_kwh"), F.max("l_quantity").alias("active_power_kw")
        )
        listed = hours.groupBy("object_id", "ts").agg(
            F.collect_list(F.struct("slot", "energy_kwh", "active_power_kw")).alias("subs"),
            F.sum("energy_kwh").alias("e"), F.sum("active_power_kw").alias("p"),
        )
        main = F.struct(F.lit(1).alias("slot"), F.col("e").alias("energy_kwh"), F.col("p").alias("active_power_kw"))
        rows = listed.select("object_id", "ts", F.inline(F.array_append("subs", main)))
        return rows.select("object_id", "slot", "ts", "energy_kwh", "active_power_kw")

    @cached_property
    def site_readings(self) -> DataFrame:
        """Readings that carry what the meter dimension says of their meter, so
        that site reports need no join with it."""
        names, types, levels, places = (F.array(*[F.lit(slot[i]) for slot in C.METER_SLOTS]) for i in (1, 2, 3, 4))
        base = with_electrical(self.readings.withColumn("meter_id", meter_id()))
        return base.select(
            "meter_id", "ts", "object_id", F.element_at(types, F.col("slot")).alias("meter_type"),
            F.element_at(levels, F.col("slot")).cast("short").alias("level"), F.element_at(names, F.col("slot")).alias("meter_name"),
            F.element_at(places, F.col("slot")).alias("location"), "active_power_kw", "power_factor", "energy_kwh",
        )

    @cached_property
    def measurements(self) -> DataFrame:
        """The measurements table (meter_id, ts, ...), cumulative via G3."""
        from ..operators.jobs import cumulative_totalizer

        base = with_electrical(self.readings.withColumn("meter_id", meter_id()))
        return cumulative_totalizer(base).select(
            "meter_id", "ts", "active_power_kw", "reactive_power_kvar", "voltage_v", "current_a",
            "power_factor", "energy_kwh", "cumulative_kwh", "quality_flag",
        )

    @cached_property
    def measurements_nocum(self) -> DataFrame:
        """Measurements without the running totalizer (cheaper; cumulative NULL)."""
        base = with_electrical(self.readings.withColumn("meter_id", meter_id()))
        return base.select(
            "meter_id", "ts", "active_power_kw", "reactive_power_kvar", "voltage_v", "current_a",
            "power_factor", "energy_kwh", F.lit(None).cast("double").alias("cumulative_kwh"), "quality_flag",
        )

    @cached_property
    def site_hours(self) -> DataFrame:
        """Readings and telemetry in one table, written bucketed to a scratch folder."""
        rows = site_hours(self.measurements_nocum, self.meters, self.solar, self.battery, self.tz)
        return write_site_hours(rows, scratch_path(self.spark, "site-hours", self.sf_dir))

    @cached_property
    def weather_full(self) -> DataFrame:
        return weather_from_hours(weather_hours(self.weather_sites), self.tz)

    @cached_property
    def weather(self) -> DataFrame:
        return self.weather_full.drop("_gap")

    @cached_property
    def weather_gappy(self) -> DataFrame:
        """Weather with hours missing where (local doy + hour) % 11 = 5."""
        return self.weather_full.filter(~F.col("_gap")).drop("_gap")

    @cached_property
    def solar(self) -> DataFrame:
        s = with_weather(self.sub.filter(F.col("slot") == 5), self.tz)
        return s.select(
            "object_id",
            "ts",
            F.col("active_power_kw").alias("power_kw"),
            "energy_kwh",
            rnd(ph.solar_efficiency_pct("active_power_kw"), 2).alias("efficiency_pct"),
            F.lit(0.0).alias("curtailed_kwh"),
            F.col("solar_irradiance_wm2").alias("irradiance_wm2"),
            "temperature_c",
            rnd(F.col("active_power_kw") / C.INVERTER_EFFICIENCY, 3).alias("dc_power_kw"),
        )

    @cached_property
    def battery(self) -> DataFrame:
        b = self.sub.filter(F.col("slot") == 6)
        p = F.col("battery_power_kw")
        soc_pct = (10 + F.col("max_orderkey") % 86).cast("double")
        return b.select(
            "object_id",
            "ts",
            soc_pct.alias("soc_pct"),
            rnd(soc_pct * C.BATTERY_CAPACITY_KWH / 100, 3).alias("soc_kwh"),
            p.alias("power_kw"),
            F.abs(p).alias("energy_kwh"),
            F.when(p > 0, F.lit("charging")).when(p < 0, F.lit("discharging")).otherwise(F.lit("idle")).alias("mode"),
            ph.battery_voltage(soc_pct).alias("voltage_v"),
            F.lit(100.0).alias("health_pct"),
        )

    @cached_property
    def battery_full(self) -> DataFrame:
        """Battery telemetry with its temperature and running cycle count."""
        from ..operators.jobs import with_cycle_count

        own = self.battery.columns
        return with_cycle_count(with_weather(self.battery, self.tz).select(*own, "temperature_c"))

    @cached_property
    def dirty_measurements(self) -> DataFrame:
        """One reading per line item with injected faults, for the quality checks."""
        k = F.col("l_orderkey")
        r = self.raw.withColumn("meter_id", meter_id())
        power = F.when(k % 83 == 0, F.lit(None).cast("double")).when(k % 97 == 0, -F.col("l_quantity")).otherwise(
            F.col("l_quantity")
        )
        h = F.hour("ts")
        pf = (F.lit(0.80).cast("decimal(3,2)") + (h % 20) * F.lit(0.01).cast("decimal(3,2)")).cast("double")
        return r.select(
            F.when(k % 73 == 0, F.lit(99)).otherwise(F.col("meter_id")).cast("int").alias("meter_id"),
            "ts",
            power.alias("active_power_kw"),
            F.when(k % 89 == 0, F.lit(1.2)).otherwise(pf).alias("power_factor"),
            F.col("l_quantity").alias("energy_kwh"),
            F.when(k % 79 == 0, F.lit(7)).otherwise(F.lit(1)).cast("short").alias("quality_flag"),
            (210 + (h * 3) % 26).cast("double").alias("voltage_v"),
        )

    @cached_property
    def baseline(self) -> DataFrame:
        from ..operators.jobs import build_baseline

        return build_baseline(self)

    @cached_property
    def daily_metrics(self) -> DataFrame:
        from ..operators.jobs import daily_metrics

        return daily_metrics(self)

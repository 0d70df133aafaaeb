"""SQL views (A6) and the yearly report batch."""

from pyspark.sql import functions as F

from meterframe.operators import analytics as an
from meterframe.operators import views as vw
from meterframe.plans import sql_views as sv


def test_views_are_queryable_with_sql(spark, tables):
    names = sv.register_views(tables)
    assert "level_1_consumption" in names and "measurements" in names
    got = {r[0]: r[1] for r in spark.sql(
        "SELECT object_id, SUM(energy_kwh) FROM level_1_consumption GROUP BY object_id").collect()}
    l1 = vw.level_1_consumption(tables.measurements_nocum, tables.meters)
    want = {r[0]: r[1] for r in l1.groupBy("object_id").agg(F.sum("energy_kwh")).collect()}
    assert got == want
    sv.drop_views(spark)
    assert not any(t.name == "level_1_consumption" for t in spark.catalog.listTables())


def test_run_reports_writes_every_report(spark, tables, tmp_path):
    paths = sv.run_reports(tables, str(tmp_path), 2025)
    assert len(paths) == 10
    daily = spark.read.option("header", True).csv(paths["01_daily_consumption"])
    l1 = vw.level_1_consumption(tables.measurements_nocum, tables.meters)
    assert daily.count() == an.daily_consumption(l1, "2025-01-01", "2025-12-31").count()

"""The partitions of site hours follow the size of the line items."""

import datetime as dt

from pyspark.sql import functions as F

from meterframe.sources.fixtures import FEW_SPLITS, PARTS_PER_SPLIT, MeterTables


def lineitem(spark, path, files):
    rows = [(k, k % 9, k % 8, k % 7, float(k % 5), dt.datetime(1994, 3, 1) + dt.timedelta(days=k % 200)) for k in range(600)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_shipdate timestamp").repartition(files).write.parquet(f"{path}/lineitem.parquet")
    return MeterTables(spark, str(path))


def test_partitions_of_site_hours_follow_the_splits(spark, tmp_path):
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")  # every file a split or more
    try:
        few, many = lineitem(spark, tmp_path / "few", 1), lineitem(spark, tmp_path / "many", 12)
        for t in (few, many):
            t.readings  # planned under this split size
        splits = many.lineitem.rdd.getNumPartitions()
        assert splits > FEW_SPLITS
        made = many.readings.groupBy(F.spark_partition_id()).count().count()
        assert made > 4 * 4  # more than the session's four shuffle partitions, whatever is adaptively joined
        assert made <= PARTS_PER_SPLIT * splits
        key = ["object_id", "slot", "ts"]
        assert sorted(map(tuple, many.readings.orderBy(*key).collect())) == sorted(map(tuple, few.readings.orderBy(*key).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def test_partitions_of_telemetry_follow_the_splits(spark, tmp_path):
    """Solar and battery rows, which the daily metrics add to the readings."""
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        few, many = lineitem(spark, tmp_path / "few", 1), lineitem(spark, tmp_path / "many", 12)
        for made in (lambda t: t.sub, lambda t: t.solar, lambda t: t.battery):
            rows = made(few).orderBy("object_id", "ts").collect()
            assert made(many).groupBy(F.spark_partition_id()).count().count() > 4 * 4
            assert len(rows) and sorted(map(str, made(many).collect())) == sorted(map(str, rows))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)

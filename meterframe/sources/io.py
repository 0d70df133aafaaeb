"""Sources and sinks: typed scans, partitioned bulk load, idempotent load,
CSV reports (A1, A4, A5, A7), and a JDBC reader option.

Tables are written as Parquet partitioned by ``year, month`` of ``ts`` (UTC),
so a time-range scan prunes partitions and pushes the ``ts`` bounds into the
row-group filter.  Writes are distributed: every task writes its own files.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def table_root(spark: SparkSession, *parts: str) -> str:
    """A folder under the session's shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "meterframe", *parts])


def scratch_path(spark: SparkSession, name: str, key: str = "") -> str:
    """A fresh, unique folder for one run (never reused, never cleaned up by rm)."""
    tag = hashlib.sha1(key.encode()).hexdigest()[:10] if key else "x"
    return table_root(spark, name, f"{tag}-{uuid.uuid4().hex[:12]}")


def with_partitions(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumn("year", F.year(ts)).withColumn("month", F.month(ts))


def scan(
    spark: SparkSession, path: str, schema: T.StructType, start=None, end=None, columns=None, ts: str = "ts",
    keep_partitions: bool = False,
) -> DataFrame:
    """Typed Parquet scan with an explicit schema (never inferred) (A1).

    The half-open ``[start, end)`` bound is on the stored ``ts`` column and on
    the ``year, month`` partition columns, so both partition pruning and
    row-group pushdown apply.  Partition columns are dropped from the result.
    """
    part = T.StructType(list(schema.fields) + [T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())])
    df = spark.read.schema(part).parquet(path)
    # The month predicates prune year=/month= partitions; on a table laid out
    # otherwise the columns read as NULL and the predicates pass every row.
    kind = schema[ts].dataType
    bound = lambda t: F.lit(str(t)).cast(kind)
    code = lambda t: int(str(t)[:4]) * 100 + int(str(t)[5:7] or 1)
    month = F.col("year") * 100 + F.col("month")
    if start is not None:
        df = df.filter((F.col(ts) >= bound(start)) & (month.isNull() | (month >= code(start))))
    if end is not None:
        df = df.filter((F.col(ts) < bound(end)) & (month.isNull() | (month <= code(end))))
    if not keep_partitions:
        df = df.drop("year", "month")
    return df.select(*columns) if columns else df


def with_column_defaults(df: DataFrame, defaults: dict, schema: T.StructType | None = None) -> DataFrame:
    """Add absent columns with their default value (an insert that omits a
    column gets the default; an explicit NULL stays NULL)."""
    types = {f.name: f.dataType for f in schema.fields} if schema is not None else {}
    for name, value in defaults.items():
        if name not in df.columns:
            lit = F.lit(value)
            df = df.withColumn(name, lit.cast(types[name]) if name in types else lit)
    return df


def bulk_load(df: DataFrame, path: str, mode: str = "append", ts: str = "ts", max_records_per_file: int = 5_000_000, cluster: str | None = None, files: int | None = None) -> None:
    """Append rows to a year/month-partitioned Parquet table (A4).

    Rows are rebalanced on (year, month), so a month goes to few files, and
    adaptive execution splits a large month over as many tasks as its size
    asks for; each task sorts by ``ts``, which makes row-group skipping work.

    With ``cluster`` (a column, such as the meter) rows are dealt out by ranges
    of (year, month, cluster) to ``files`` tasks and sorted by (cluster, ts): one
    meter's readings of a month lie together, in one file or two neighbours, and
    a range scan of a meter skips the other files and row groups by their
    statistics.  A meter with very many rows is spread by ``ts`` as well.
    """
    rows = with_partitions(df, ts)
    if cluster is not None:
        files = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        placed = rows.repartitionByRange(files, "year", "month", cluster, ts).sortWithinPartitions("year", "month", cluster, ts)
    else:
        placed = rows.hint("rebalance", "year", "month").sortWithinPartitions("year", "month", ts)
    (
        placed.write.mode(mode)
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy("year", "month")
        .parquet(path)
    )


def idempotent_load(spark: SparkSession, new: DataFrame, path: str, schema: T.StructType, key: list[str], ts: str = "ts") -> None:
    """Append only rows whose natural key is not yet in the table (A5).

    A key that the batch itself repeats is appended once (the smallest row).
    A left-anti join of the batch against the stored keys; re-running the
    same batch appends nothing.  The stored key listing is taken when the
    job is planned, and the append commits its files at the end, so the read
    never sees the job's own output.
    """
    batch = new
    rest = [c for c in new.columns if c not in key]
    # Rows are dealt by key once, unsorted before; the table's keys meet them there.
    smallest = Window.partitionBy(*key).orderBy(*(rest or key))
    new = new.repartition(*key).withColumn("_nth", F.row_number().over(smallest)).filter(F.col("_nth") == 1).drop("_nth")
    if table_exists(spark, path):
        # Only partitions the batch touches can hold its keys: list them (one
        # row per month, a bounded result) and prune the existing-key scan.
        months = [(r[0], r[1]) for r in with_partitions(batch, ts).select("year", "month").distinct().collect()]
        existing = scan(spark, path, schema, keep_partitions=True)
        if months:
            cond = F.col("year").isNull()  # a table not laid out by year/month: keep every key
            for y, m in months:
                cond = cond | ((F.col("year") == y) & (F.col("month") == m))
            existing = existing.filter(cond)
        stored = existing.select(*key)
        # A batch that is stored already, as on a re-run, is found by its keys alone.
        if batch.select(*key).join(stored, key, "left_anti").isEmpty():
            return
        new = new.join(stored, key, "left_anti")
    bulk_load(new, path, "append", ts)


def table_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


def is_directory(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath) and fs.getFileStatus(jpath).isDirectory())


SINGLE_FILE_ROWS = 100_000


BOM = "\ufeff"


def report_csv(df: DataFrame, path: str, order: list[str] | None = None, single_file: bool = False, bom: bool = True) -> None:
    """Write a report as CSV with a header row (A7), ordered by ``order``, in
    UTF-8 with a byte order mark at the head of every file (``bom``).

    Reports are small and leave the system here, so this is where a global
    sort belongs.  By default every task writes its own part file, in order.
    ``single_file`` puts all rows into one task; it is refused beyond
    SINGLE_FILE_ROWS rows.
    """
    if single_file:
        if df.limit(SINGLE_FILE_ROWS + 1).count() > SINGLE_FILE_ROWS:
            raise ValueError(f"more than {SINGLE_FILE_ROWS} rows: write part files instead")
        df = df.coalesce(1)
        df = df.sortWithinPartitions(*order) if order else df
    elif order:
        df = df.orderBy(*order)
    if bom and df.columns:  # the header is what a file begins with
        df = df.toDF(BOM + df.columns[0], *df.columns[1:])
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: int,
    upper: int,
    num_partitions: int,
    properties: dict | None = None,
) -> DataFrame:
    """Parallel JDBC read split on a numeric column (A1 connector option).

    Not exercised offline; the caller supplies the driver on the classpath.
    """
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=num_partitions,
        properties=properties or {},
    )

"""Shared helpers of the training-data operators."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.io import scratch_path
from . import textops

# Worker functions and the kernels they call are pickled by value, so Python
# workers need neither an installed package nor the driver's working folder.
cloudpickle.register_pickle_by_value(textops)


def by_value(module_name: str) -> None:
    """Ship the functions of this module by value."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


by_value(__name__)


ARROW_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Whole texts are long rows: send them to Python workers a thousand at a
    time, where the session does not ask for fewer."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    small_batches(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write under the shared checkpoint folder and read back: cuts lineage,
    so a lost executor recomputes nothing of what came before."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucket(column: Column | str, modulus: int) -> Column:
    """crc32 of an id written as text, modulo ``modulus``: the fold of a row."""
    return F.crc32(F.col(column).cast("string") if isinstance(column, str) else column.cast("string")) % modulus


def fresh(name: str, taken) -> str:
    """A column name that no column in ``taken`` has, whatever its case."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name = f"_{name}"
    return name


BROADCAST_ROWS = 500_000


def small(df: DataFrame) -> DataFrame:
    """A stored frame of short rows, to be broadcast if it has at most
    BROADCAST_ROWS; beyond that Spark shuffles both sides."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


FILTER_BITS = 24


def key_filter(keys: DataFrame) -> bytes:
    """A bitmap of 2**FILTER_BITS bits over the low bits of 64-bit hash keys
    (one long column).  Its size is fixed, so it may be broadcast; a test can
    say yes to a key that is not there, never no to one that is, so it only
    ever saves work and an exact join follows."""
    low = F.col(keys.columns[0]).bitwiseAND(F.lit((1 << FILTER_BITS) - 1)) + 1
    rows = (
        keys.groupBy(F.bitmap_bucket_number(low).alias("at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(low)).alias("bits")).collect()
    )
    out = bytearray(1 << (FILTER_BITS - 3))
    for at, bits in rows:
        out[(at - 1) * len(bits) : at * len(bits)] = bits
    return bytes(out)


def maybe_in(filter_bits: bytes, keys: np.ndarray) -> np.ndarray:
    """Which int64 keys may be in the filter."""
    low = keys & ((1 << FILTER_BITS) - 1)
    return (np.frombuffer(filter_bits, dtype=np.uint8)[low >> 3] >> (low & 7)) & 1 == 1

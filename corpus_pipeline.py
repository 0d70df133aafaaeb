"""Training-data pipeline over ``documents``: five stages, each a written table.

Every stage takes (spark, docs, sf_dir), works on all its predecessor kept, and
returns the columns of ``documents``; the last adds the tokens.

1. quality     documents scored below QUALITY_FLOOR go (factorisation machine)
2. lines       repeated and similar lines go, and with them documents of which
               no line is left; ``n_chars`` follows the new text
3. duplicates  of each group of near duplicates the document with the smallest
               id stays (5-word shingles, similarity 0.8 or more)
4. benchmark   documents that hold a benchmark item go
5. tokens      BPE: n_tokens and ids of each text

Edge cases are those of the operators.  Rows that repeat a doc_id, or have none,
are told apart by their text; a null id comes before all others; rows that
repeat both id and text are one document, and stay or go together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterframe.llm import bpe, decontam, line_dedup, minhash, quality, registry
from meterframe.llm.common import small_batches, stored, table

COLUMNS = {"doc_id": "long", "text": "string", "lang": "string", "source": "string", "n_chars": "long"}


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    model = quality.fit(registry.labelled_documents(spark, sf_dir))
    scored = quality.score(docs, model, COLUMNS)
    return scored.filter(F.col("quality_score") >= registry.QUALITY_FLOOR).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    cut = line_dedup.dedup(docs.select(*COLUMNS), registry.LINE_PERCENT)
    left = cut.filter((F.col("n_removed") == 0) | (F.btrim("text", F.lit(decontam.SPACES)) != ""))
    return left.withColumn("n_chars", F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*COLUMNS)


def duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    key = F.struct("doc_id", F.xxhash64("text").alias("t"))  # one document: its id, which may be null or repeat, and its text
    linked = minhash.link(docs.select(key.alias("key"), "text"), shingle=5, percent=80, id_column="key")
    kept = linked.filter(F.col("key") == F.col("component_id")).select("key").distinct()
    same = F.col("doc_id").eqNullSafe(F.col("key.doc_id")) & (F.xxhash64("text") == F.col("key.t"))
    return docs.select(*COLUMNS).join(kept, same, "left_semi")


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    items = table(spark, sf_dir, "benchmark", "item_id", "text")
    return decontam.clean(docs.select(*COLUMNS), items, registry.LEAK_SIMILARITY)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return bpe.encode_columns(docs.select(*COLUMNS), COLUMNS, registry.vocabulary_path())


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("duplicates", duplicate_stage),
    ("benchmark", benchmark_stage),
    ("tokens", token_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL cannot express the classifier; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None

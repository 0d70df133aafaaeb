"""Registered queries of the training-data operators: thin wrappers that apply
an operator with its production parameters to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, brown_lm, chat_format, decontam, divergence, langid, line_dedup, minhash, negatives, quality, repeats, simhash
from .common import bucket, table

QUALITY_FLOOR = 0.3
LEAK_SIMILARITY = 0.8
LINE_PERCENT = 80
NEIGHBOURS = 20
VOCABULARY = "word_bpe_49k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_minmax_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = minhash.link(table(spark, sf_dir, "documents", "doc_id", "text"), shingle=3, percent=85)
    return linked.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").unionByName(extra)
    return chat_format.digest(chat_format.format_chat(chat_format.canonical_turns(rows)))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: numbers of lines and of removed lines, and the text that stays."""
    cut = line_dedup.dedup(table(spark, sf_dir, "documents", "doc_id", "text"), LINE_PERCENT)
    return cut.select("doc_id", "n_lines", "n_removed", "text")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(table(spark, sf_dir, "documents", "doc_id", "text"), vocabulary_path())


def op5_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and benchmark item it holds; clean documents have
    none."""
    docs, items = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text")
    return decontam.matches(docs, items, LEAK_SIMILARITY).select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "similarity")


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a quality label, without the held-out fold."""
    labels = table(spark, sf_dir, "labels", "doc_id", "quality").filter(F.col("quality").isNotNull() & (bucket("doc_id", 5) != 0))
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "n_chars")
    return docs.join(labels, "doc_id").withColumnRenamed("quality", "label")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = quality.fit(labelled_documents(spark, sf_dir))
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "n_chars")
    scored = quality.score(docs, model, {"doc_id": "long"})
    return scored.select(
        "doc_id",
        F.coalesce(bucket("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= QUALITY_FLOOR).cast("int").alias("predicted"),
    )


def op7_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model, vocabulary = brown_lm.fit(docs.filter(bucket("doc_id", 5) != 1))
    scored = brown_lm.score(docs, model, vocabulary)
    return scored.select(
        "doc_id", F.coalesce(bucket("doc_id", 5) == 1, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op8_hash_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return ann.nearest(vectors, F.col("id") % 20 == 0, NEIGHBOURS)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = langid.fit(docs.filter(bucket("doc_id", 3) != 1))
    found = langid.predict(docs, model, {"doc_id": "long"})
    return found.select("doc_id", F.coalesce(bucket("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op10_prefix_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_deletion_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = simhash.link(table(spark, sf_dir, "documents", "doc_id", "text"), shingle=3, radius=2)
    return linked.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents", "lang", "source", "text"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows, F.col("id") % 100 == 0, label=label)


QUERIES = {
    "op1_minmax_hash": op1_minmax_hash,
    "op2_chat_format": op2_chat_format,
    "op3_line_dedup": op3_line_dedup,
    "op4_bpe": op4_bpe,
    "op5_simhash_windows": op5_simhash_windows,
    "op6_quality": op6_quality,
    "op7_brown_lm": op7_brown_lm,
    "op8_hash_prefix_forest": op8_hash_prefix_forest,
    "op9_language_id": op9_language_id,
    "op10_prefix_doubling": op10_prefix_doubling,
    "op11_deletion_variants": op11_deletion_variants,
    "op12_source_divergence": op12_source_divergence,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE: dict[str, str] = {
    "op2_chat_format": r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
    SELECT *, 4 + 2 + 8
        + length(role) + length(role) - length(replace(role, '\', '')) + length(role) - length(replace(role, ':', ''))
        + length(text) + length(text) - length(replace(text, '\', ''))
        - 5 * ((length(text) - length(replace(text, '</turn>', ''))) // 7)
        - 2 * ((length(text) - length(replace(text, '### ', ''))) // 4) AS n
    FROM rows
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(n) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id""",
    "op5_simhash_windows": r"""
WITH d AS (
    SELECT DISTINCT doc_id, string_split_regex(trim(lower(text), e' \t\n\x0b\f\r'), '[ \t\n\x0B\f\r]+') AS w
    FROM documents WHERE trim(lower(text), e' \t\n\x0b\f\r') <> ''
), i AS (
    SELECT DISTINCT item_id, string_split_regex(trim(lower(text), e' \t\n\x0b\f\r'), '[ \t\n\x0B\f\r]+') AS w
    FROM benchmark WHERE trim(lower(text), e' \t\n\x0b\f\r') <> ''
), iw AS (SELECT item_id, w, len(w) AS n, least(len(w), 5) AS k FROM i),
ks AS (SELECT DISTINCT k FROM iw),
dp AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, ks),
ip AS (SELECT item_id, w, n, k, unnest(range(1, n - k + 2)) AS q FROM iw),
ds AS (SELECT doc_id, k, p, list_aggregate(w[p:p + k - 1], 'string_agg', ' ') AS s FROM dp),
isx AS (SELECT item_id, n, k, q, list_aggregate(w[q:q + k - 1], 'string_agg', ' ') AS s FROM ip),
hit AS (SELECT DISTINCT doc_id, n, isx.k, p FROM ds JOIN isx ON ds.s = isx.s AND ds.k = isx.k),
starts AS (SELECT DISTINCT doc_id, n, k, unnest(range(p + k - 1 - n, p)) AS start FROM hit),
win AS (
    SELECT DISTINCT doc_id, k, n, w[greatest(least(start, len(w) - n), 0) + 1 : greatest(least(start, len(w) - n), 0) + n] AS w
    FROM starts JOIN d USING (doc_id)
), wp AS (SELECT doc_id, k, w, unnest(range(1, greatest(len(w) - k + 1, 1) + 1)) AS p FROM win),
wb AS (
    SELECT doc_id, k, w, list_aggregate(w[p:p + k - 1], 'string_agg', ' ') AS s, count(*) AS tf FROM wp GROUP BY ALL
), ib AS (SELECT item_id, k, s, count(*) AS tf FROM isx GROUP BY ALL),
wt AS (SELECT doc_id, k, w, sum(ln(1 + length(s)) * tf) AS total FROM wb GROUP BY ALL),
it AS (SELECT item_id, sum(ln(1 + length(s)) * tf) AS total FROM ib GROUP BY ALL),
common AS (
    SELECT doc_id, wb.k, w, item_id, sum(ln(1 + length(wb.s)) * least(wb.tf, ib.tf)) AS shared
    FROM wb JOIN ib ON wb.s = ib.s GROUP BY ALL
)
SELECT doc_id, item_id, round(max(shared / (wt.total + it.total - shared)), 9) AS similarity
FROM common JOIN wt USING (doc_id, k, w) JOIN it USING (item_id)
WHERE shared / (wt.total + it.total - shared) >= 0.8 - 1e-12
GROUP BY doc_id, item_id""",
    "op12_source_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
tok AS (
    SELECT r, lang, source, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM d
), dt AS (SELECT r, lang, source, term, count(*) AS n FROM tok GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS n FROM dt GROUP BY ALL HAVING count(*) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, sum(dt.n) AS n FROM dt JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
sizes AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (
    SELECT lang, source, term, coalesce(c.n, 0) AS n,
        CAST(1 + CAST(1000000000 * (coalesce(c.n, 0) + 5) AS HUGEINT) // CAST(sizes.total + 5 * v AS HUGEINT) AS BIGINT) AS p,
        CAST(1 + CAST(1000000000 * (kept.n + 5) AS HUGEINT) // CAST(langs.total + 5 * v AS HUGEINT) AS BIGINT) AS q
    FROM sizes JOIN kept USING (lang) JOIN langs USING (lang) LEFT JOIN c USING (lang, source, term)
), apart AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y USING (lang, term) WHERE x.source <> y.source GROUP BY ALL),
pairs AS (
    SELECT x.lang, x.source, 'pair' AS part, y.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
    FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN apart a ON a.lang = x.lang AND a.source = x.source AND a.item = y.source
), found AS (
    SELECT * FROM pairs UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value,
    CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM found QUALIFY part = 'pair' OR row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) <= 50""",
    "op13_hard_negatives": r"""
WITH r AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
    FROM r a JOIN r ON a.vec_id <> r.vec_id AND len(a.v) = len(r.v) WHERE a.vec_id % 100 = 0
), pos AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
    s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM pos p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) <= 10""",
}

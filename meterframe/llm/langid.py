"""Language identification by nearest centroid.

A text is a normalised TF-IDF vector of hashed letter n-grams (one to three
bytes; everything that is no letter separates words).  Each language has
several centroids, found by spherical k-means over its own vectors.  The
nearest centroid by cosine names the language.  With ``reject_at`` a text whose
best cosine is not above it is rejected as ``und``; a text without a letter
always is.

Document frequencies cover all labelled rows.  Centroids are fitted on at most
about ``SAMPLE_PER_LANGUAGE`` labelled rows of each language, however many there
are, drawn by a hash of the row id; prediction covers every row and scores it
against blocks of centroids.  One task fits one language's sample.

Edge cases: null, empty and letterless texts give ``und`` with score 0; very
long texts are read whole; a tie between languages goes to the smaller name,
also between all of them, for a text with letters that no language has;
repeated rows repeat; an empty table gives an empty result; with no labelled
row every text is ``und``; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops
from .common import by_value, fresh, small, stored

by_value(__name__)

DIMENSIONS = 8192
SAMPLE_PER_LANGUAGE = 1200
CENTROIDS = 4
BLOCK = 256  # centroids scored at once
ROUNDS = 8
BATCH_DOCS = 256

# Letter codes of bytes: a-z and A-Z as 1-26, bytes of longer characters as
# 27 and up, all else 0.
_CODE = np.zeros(256, dtype=np.uint32)
_CODE[97:123] = np.arange(1, 27)
_CODE[65:91] = np.arange(1, 27)
_CODE[128:] = np.arange(27, 155)


def counts(raw: np.ndarray) -> np.ndarray:
    """Hashed n-gram counts of one text's bytes."""
    c = _CODE[raw]
    if not c.any():
        return np.zeros(DIMENSIONS)
    c = np.concatenate([[np.uint32(0)], c, [np.uint32(0)]]).astype(np.uint32)
    c = c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])]
    two = c[:-1] * np.uint32(157) + c[1:]
    three = two[:-1] * np.uint32(157) + c[2:]
    key = np.concatenate([c[c > 0], two + np.uint32(1 << 10), three + np.uint32(1 << 16)])
    key = (key * np.uint32(2654435761)) >> np.uint32(19)
    return np.bincount(key, minlength=DIMENSIONS).astype(np.float64)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def vectors(texts: pa.Array) -> np.ndarray:
    """Log-scaled counts, one row per text."""
    offsets, data = textops.columns(texts)
    out = np.zeros((len(texts), DIMENSIONS), dtype=np.float32)
    for i in range(len(texts)):
        out[i] = np.log1p(counts(data[offsets[i] : offsets[i + 1]]))
    return out


def weigh(x: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = x * idf
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def cluster(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Spherical k-means; starts from the mean and then the farthest rows."""
    centres = [x.mean(axis=0)]
    centres[0] /= max(np.linalg.norm(centres[0]), 1e-12)
    near = x @ centres[0]
    while len(centres) < min(k, len(x)):
        far = int(np.argmin(near))
        centres.append(x[far])
        near = np.maximum(near, x @ x[far])
    c = np.array(centres)
    for _ in range(rounds):
        mine = np.argmax(x @ c.T, axis=1)
        for j in range(len(c)):
            if (own := mine == j).any():
                m = x[own].mean(axis=0)
                c[j] = m / max(np.linalg.norm(m), 1e-12)
    return c


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's best centroid, the first of equal ones, and its cosine."""
    best, score = np.zeros(len(x), dtype=int), np.full(len(x), -np.inf, dtype=np.float32)
    for at in range(0, len(centroids), BLOCK):
        near = x @ centroids[at : at + BLOCK].T
        mine = np.argmax(near, axis=1)
        value = near[np.arange(len(x)), mine]
        better = value > score
        best[better], score[better] = mine[better] + at, value[better]
    return best, np.clip(score.astype(float), 0.0, 1.0)


def sample(df: DataFrame, id_column: str, text: str, lang: str, per_language: int) -> DataFrame:
    """About per_language rows of each language, chosen by a hash of the id."""
    labelled = df.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    rates = stored(
        labelled.groupBy(F.col(lang).alias("lang")).agg(F.least(F.lit(1.0), per_language / F.count("*")).alias("rate")), "langid-rates"
    )
    draw = F.pmod(F.xxhash64(F.col(id_column)), F.lit(1 << 20)) / F.lit(1 << 20)
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"), draw.alias("draw"))
    return rows.join(small(rates), "lang").filter("draw < rate").select("lang", "text")


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """The number of texts, and of those that hold each n-gram.  A task sends at
    most DIMENSIONS + 1 rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(DIMENSIONS + 1, dtype=np.int64)  # the last counts texts
        for b in batches:
            offsets, data = textops.columns(b.column(0))
            for i in range(b.num_rows):
                seen[:-1] += counts(data[offsets[i] : offsets[i + 1]]) > 0
            seen[-1] += b.num_rows
        some = np.flatnonzero(seen)
        yield pa.record_batch([pa.array(some), pa.array(seen[some])], names=["slot", "n"])

    out = np.zeros(DIMENSIONS + 1)
    for slot, n in texts.mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n")).collect():
        out[slot] = n
    return int(out[-1]), out[:-1]


def fit(df: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE) -> dict:
    """idf, centroids and the language of each, CENTROIDS * DIMENSIONS 4-byte
    numbers a language."""
    rows = stored(sample(df, id_column, text, lang, per_language), "langid-sample")

    n, seen = document_frequencies(df.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(text))
    idf = (np.log((1 + n) / (1 + seen)) + 1).astype(np.float32)

    def centroids(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("text")
        x = weigh(vectors(pa.array(group["text"], pa.large_string())), idf)
        c = cluster(x[np.abs(x).sum(axis=1) > 0], CENTROIDS, ROUNDS) if np.abs(x).sum() > 0 else x[:0]
        return pd.DataFrame({"lang": [group["lang"].iloc[0]] * len(c), "c": [v.astype(np.float32).tobytes() for v in c]})

    got = sorted(((r["lang"], r["c"]) for r in rows.groupBy("lang").applyInPandas(centroids, "lang string, c binary").collect()), key=lambda r: r[0])
    return {"idf": idf, "lang": [r[0] for r in got], "centroids": np.frombuffer(b"".join(r[1] for r in got), dtype=np.float32).reshape(len(got), DIMENSIONS)}


def predict(df: DataFrame, model: dict, columns: dict[str, str], text: str = "text", reject_at: float | None = None) -> DataFrame:
    """lang_pred and score for every row, beside the given columns (name: type)."""
    kept = df.sparkSession.sparkContext.broadcast(model)
    names = list(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = kept.value
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_DOCS):
                b = whole.slice(at, BATCH_DOCS)
                texts = b.column(len(names))
                x = weigh(vectors(texts), m["idf"])
                if len(m["lang"]):
                    best, score = nearest(x, m["centroids"])
                else:
                    best, score = np.zeros(len(x), dtype=int), np.zeros(len(x))
                far = (score <= reject_at) if reject_at is not None else np.zeros(len(x), dtype=bool)
                lang = []
                for i, j in enumerate(best):
                    if len(m["lang"]) and not far[i] and has_letter(texts[i].as_py()):
                        lang.append(m["lang"][j])
                    else:
                        lang.append("und")
                        score[i] = 0.0
                yield pa.record_batch([*(b.column(i) for i in range(len(names))), pa.array(lang, pa.string()), pa.array(score)], names=[*names, "lang_pred", "score"])

    schema = ", ".join([*(f"{n} {t}" for n, t in columns.items()), "lang_pred string", "score double"])
    return df.select(*names, F.col(text).alias(fresh("_text", names))).mapInArrow(run, schema)

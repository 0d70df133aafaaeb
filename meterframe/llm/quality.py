"""Quality classifier: a factorisation machine.

A text is a sparse vector of hashed words (log counts, unit length), structure
statistics (lengths, shares of upper case, digits, signs, long characters,
distinct words, repeated lines) and metadata columns.  The score is the
logistic of ``w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j``; the pairwise
part takes linear time as half the sum over factors of
``(sum v_if x_i)^2 - sum v_if^2 x_i^2``.

It is fitted on at most about ``SAMPLE_ROWS`` labelled rows, drawn by a hash of
the row id, by Adam in one task; scoring covers every row.

Edge cases: null and empty texts have no words and structure statistics of
zero, and are scored like any other; a null metadata value counts as zero with
its own indicator; very long texts are read whole; repeated rows repeat; with
no labelled row, or one class only, the score is the smoothed class share; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops
from .common import by_value, fresh, stored

by_value(__name__)

SAMPLE_ROWS = 12_000
WORD_SLOTS = 1 << 15
FACTORS = 8
EPOCHS = 6
LEAST_STEPS = 600  # a small sample is gone through more often
BATCH = 128
BINS = 8  # each statistic also has one indicator per bin


def _table(chars) -> np.ndarray:
    out = np.zeros(256, dtype=np.int64)
    out[list(chars)] = 1
    return out


# Classes of bytes whose shares describe a text's structure.
CLASSES = {
    "upper": _table(range(65, 91)),
    "lower": _table(range(97, 123)),
    "digit": _table(range(48, 58)),
    "space": _table([32, 9, 11, 12, 13]),
    "line": _table([10]),
    "stop": _table(b".,;:!?"),
    "sign": _table([c for c in range(33, 127) if not chr(c).isalnum() and c not in b".,;:!?'\"-"]),
    "long": _table(range(128, 256)),
}
STATS = [*CLASSES, "log_bytes", "log_words", "mean_word", "distinct_words", "mean_line", "distinct_lines"]


def features(texts: pa.Array, meta: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row starts, feature index, value) of runs of documents."""
    offsets, data = textops.columns(texts)
    for a, b in textops.runs(offsets):
        yield _run(offsets[a : b + 1], data, [m[a:b] for m in meta])


def _run(offsets: np.ndarray, data: np.ndarray, meta: list[np.ndarray]):
    n = len(offsets) - 1
    raw = data[offsets[0] : offsets[-1]]
    cut = offsets - offsets[0]
    size = np.maximum(np.diff(cut), 1).astype(float)
    stats = []
    for marks in CLASSES.values():
        total = np.concatenate([[0], np.cumsum(marks[raw])])
        stats.append((total[cut[1:]] - total[cut[:-1]]) / size)
    w = textops.words(offsets, data)
    n_words = np.bincount(w.row, minlength=n)
    slot = (w.hash >> np.uint64(49)).astype(np.int64)
    key = w.row * WORD_SLOTS + slot
    cells, count = np.unique(key, return_counts=True)
    row, slot = cells // WORD_SLOTS, cells % WORD_SLOTS
    value = np.log1p(count)
    norm = np.sqrt(np.bincount(row, weights=value * value, minlength=n))
    value = value / norm[row]
    n_distinct = np.bincount(row, minlength=n)
    lines = _line_shares(raw, cut)
    some = np.maximum(n_words, 1)
    stats += [
        np.log1p(np.diff(cut)) / 12, np.log1p(n_words) / 10, np.bincount(w.row, weights=(w.end - w.start), minlength=n) / some / 20,
        n_distinct / some, np.log1p(lines[0]) / 10, lines[1],
    ]
    dense = []
    for m in meta:
        known = ~np.isnan(m)
        dense += [known.astype(float), np.where(known, np.log1p(np.maximum(np.nan_to_num(m), 0)) / 12, 0.0)]
    base = WORD_SLOTS
    rows, index, values = [row], [slot], [value]
    every = np.arange(n)
    for j, s in enumerate([*stats, *dense]):
        rows += [every, every]
        at = base + j * (BINS + 1)
        bins = np.minimum((np.sqrt(np.clip(s, 0, 1)) * BINS).astype(np.int64), BINS - 1)
        index += [np.full(n, at), at + 1 + bins]
        values += [np.clip(s, 0, 1), np.ones(n)]
    rows, index, values = np.concatenate(rows), np.concatenate(index), np.concatenate(values)
    order = np.argsort(rows, kind="stable")
    starts = np.searchsorted(rows[order], every)
    return starts, index[order], values[order].astype(np.float64)


def _line_shares(raw: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean line length, and the share of distinct lines, of each document."""
    n = len(cut) - 1
    edge = np.unique(np.concatenate([np.flatnonzero(raw == 10) + 1, cut[:-1], cut[-1:]]))
    start, end = edge[:-1], edge[1:]
    if not len(start):
        return np.zeros(n), np.ones(n)
    row = np.searchsorted(cut, start, side="right") - 1
    h = textops.poly_range(textops.poly(raw), start, end)
    total = np.maximum(np.bincount(row, minlength=n), 1)
    r, _ = textops.distinct(row, h)
    return np.diff(cut) / total, np.bincount(r, minlength=n) / total


def n_features(n_meta: int) -> int:
    return WORD_SLOTS + (len(STATS) + 2 * n_meta) * (BINS + 1)


def margin(model: dict, starts: np.ndarray, index: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The machine's output before the logistic, in time linear in the features."""
    vx = model["v"][index] * value[:, None]
    sums = np.add.reduceat(vx, starts, axis=0)
    squares = np.add.reduceat(vx * vx, starts, axis=0)
    linear = np.add.reduceat(model["w"][index] * value, starts)
    return model["w0"] + linear + 0.5 * (sums * sums - squares).sum(axis=1)


def train(label: np.ndarray, rows: list[tuple[np.ndarray, np.ndarray]], size: int, seed: int = 7) -> dict:
    """Adam on the logistic loss with a small L2 penalty."""
    rng = np.random.default_rng(seed)
    y = label.astype(float)
    share = (y.sum() + 1) / (len(y) + 2)
    model = {"w0": float(np.log(share / (1 - share))), "w": np.zeros(size), "v": rng.normal(0, 0.01, (size, FACTORS))}
    if len(y) == 0 or y.min() == y.max():
        model["v"] = np.zeros((size, FACTORS))
        return model
    first = {k: np.zeros_like(np.asarray(model[k], dtype=float)) for k in ("w0", "w", "v")}
    second = {k: np.zeros_like(a) for k, a in first.items()}
    step = 0
    total = max(EPOCHS * -(-len(y) // BATCH), LEAST_STEPS)
    while step < total:
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            pick = order[at : at + BATCH]
            length = np.array([len(rows[i][0]) for i in pick])
            starts = np.cumsum(length) - length
            index = np.concatenate([rows[i][0] for i in pick])
            value = np.concatenate([rows[i][1] for i in pick])
            doc = np.repeat(np.arange(len(pick)), length)
            vx = model["v"][index] * value[:, None]
            sums = np.add.reduceat(vx, starts, axis=0)
            z = model["w0"] + np.add.reduceat(model["w"][index] * value, starts) + 0.5 * (sums * sums - np.add.reduceat(vx * vx, starts, axis=0)).sum(axis=1)
            err = (1 / (1 + np.exp(-z)) - y[pick]) / len(pick)
            used, slot = np.unique(index, return_inverse=True)
            e = err[doc] * value
            step += 1
            rate = 0.02 / (1 + 5 * step / total)
            pull = e[:, None] * (sums[doc] - vx)
            gv = np.stack([np.bincount(slot, weights=pull[:, f], minlength=len(used)) for f in range(FACTORS)], axis=1)
            gw = np.bincount(slot, weights=e, minlength=len(used))
            for k, g, at_k in (("w0", err.sum(), ...), ("w", gw + 1e-6 * model["w"][used], used), ("v", gv + 1e-5 * model["v"][used], used)):
                first[k][at_k] = 0.9 * first[k][at_k] + 0.1 * g
                second[k][at_k] = 0.999 * second[k][at_k] + 0.001 * g * g
                move = rate * (first[k][at_k] / (1 - 0.9**step)) / (np.sqrt(second[k][at_k] / (1 - 0.999**step)) + 1e-8)
                if k == "w0":
                    model["w0"] -= float(move)
                else:
                    model[k][at_k] -= move
    return model


def _meta(batch: pa.RecordBatch, first: int, n: int) -> list[np.ndarray]:
    return [np.asarray(batch.column(first + i).cast(pa.float64()).to_numpy(zero_copy_only=False), dtype=float) for i in range(n)]


def fit(labelled: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "label", metadata=("n_chars",), rows: int = SAMPLE_ROWS) -> dict:
    """Fit on about ``rows`` labelled rows; the model's size is fixed."""
    n_meta, size = len(metadata), n_features(len(metadata))
    known = labelled.filter(F.col(label).isNotNull())
    rate = min(1.0, rows / max(1, known.count()))
    draw = F.pmod(F.xxhash64(F.col(id_column)), F.lit(1 << 20)) / F.lit(1 << 20)
    drawn = known.filter(draw < rate).select(
        F.col(label).cast("int").alias("label"), *(F.col(m).alias(f"meta{i}") for i, m in enumerate(metadata)), F.col(text).alias("text")
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for starts, index, value in features(b.column(n_meta + 1), _meta(b, 1, n_meta)):
                ends = np.append(starts[1:], len(index))
                yield pa.record_batch(
                    [b.column(0).slice(at, len(starts)), pa.array([index[s:e].astype(np.int32) for s, e in zip(starts, ends, strict=True)], pa.list_(pa.int32())), pa.array([value[s:e].astype(np.float32) for s, e in zip(starts, ends, strict=True)], pa.list_(pa.float32()))],
                    names=["label", "index", "value"],
                )
                at += len(starts)
        textops.release()

    encoded = stored(drawn.mapInArrow(encode, "label int, index array<int>, value array<float>"), "quality-sample")

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        pairs = [(np.asarray(i, dtype=np.int64), np.asarray(x, dtype=float)) for i, x in zip(group["index"], group["value"], strict=True)]
        order = sorted(range(len(pairs)), key=lambda i: (pairs[i][0].tobytes(), pairs[i][1].tobytes()))
        m = train(group["label"].to_numpy()[order], [pairs[i] for i in order], size)
        return pd.DataFrame({"w0": [m["w0"]], "w": [m["w"].astype(np.float32).tobytes()], "v": [m["v"].astype(np.float32).tobytes()]})

    got = encoded.withColumn("all", F.lit("all")).groupBy("all").applyInPandas(learn, "w0 double, w binary, v binary").collect()
    if not got:
        return {**train(np.zeros(0), [], size), "metadata": tuple(metadata)}
    return {
        "w0": got[0]["w0"], "w": np.frombuffer(got[0]["w"], dtype=np.float32), "v": np.frombuffer(got[0]["v"], dtype=np.float32).reshape(size, FACTORS),
        "metadata": tuple(metadata),
    }


def score(df: DataFrame, model: dict, columns: dict[str, str], text: str = "text") -> DataFrame:
    """``quality_score`` for every row, beside the given columns (name: type)."""
    kept = df.sparkSession.sparkContext.broadcast(model)
    names, metadata = list(columns), model["metadata"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = kept.value
        for b in batches:
            if not b.num_rows:
                continue
            z = np.concatenate([margin(m, *f) for f in features(b.column(0), _meta(b, 1, len(metadata)))])
            yield pa.record_batch([*(b.column(1 + len(metadata) + i) for i in range(len(names))), pa.array(1 / (1 + np.exp(-np.clip(z, -60, 60))))], names=[*names, "quality_score"])
        textops.release()

    schema = ", ".join([*(f"`{n}` {t}" for n, t in columns.items()), "quality_score double"])
    inputs = [F.col(text).alias(fresh("_text", names)), *(F.col(m).alias(fresh(f"_meta{i}", names)) for i, m in enumerate(metadata))]
    return df.select(*inputs, *names).mapInArrow(run, schema)

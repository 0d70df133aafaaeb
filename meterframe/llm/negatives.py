"""Hard-negative mining by slot-decomposed selection.

Vectors become whole numbers, ``floor(scale * x)`` of each component, and a row's
score for an anchor is their inner product, so scores are exact.  The positives
of an anchor are its best other rows of the same label.  A positive of score P
asks for the best rows of another label whose scores lie in its window, from
``low`` to ``high`` hundredths of P.

The windows of an anchor's positives overlap.  Their upper limits cut the scores
into disjoint slots: slot s holds the scores that the s highest limits admit and
the next one does not.  One pass keeps the ``negatives`` best rows of each slot,
in every task and again after the shuffle; the answer of the i-th positive is
the beginning of the slots i, i + 1, ... one after the other (a suffix of the
slots, best first), cut at its lower limit.  No window is searched by itself.

All rows meet all anchors, in cells of one block of rows and one group of
anchors (dealt by hashes of the ids), in two passes: one for the positives, one
for the slots.  A task holds one cell, and passes on at most ``positives`` rows,
or ``negatives`` for each slot, of an anchor.  The work is rows times anchors,
as the exact answer asks for.

Edge cases: rows with a null id, label or vector, or with a null or non-finite
component take no part; an empty vector is one of length 0, and vectors meet
those of their own length only; rows that repeat id, label and vector count
once, and of an id with several vectors the best score; a row with the anchor's id is never its positive or negative; ties go to
the smaller id; an anchor without positives, or a positive with an empty window
(a negative score has one), gives no row; fewer rows than asked for are all
returned; an empty table gives an empty result; extra columns are ignored.
Inner products that could leave 64-bit numbers are an error.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import by_value, stored

by_value(__name__)

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90  # hundredths of a positive's score
SCALE = 256
BLOCK = 8192
GROUP = 2048
CHUNK = 256  # anchors scored at once

PAIR = "anchor_id long, slot int, vec_id long, score long"


def usable(df: DataFrame, label: Column, id_column: str, vector: str, scale: int) -> DataFrame:
    """(id, label, v) of the rows that take part, once each."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    rows = df.filter(F.col(id_column).isNotNull() & label.isNotNull() & v.isNotNull() & finite)
    return rows.select(F.col(id_column).cast("long").alias("id"), label.alias("label"), whole.alias("v")).distinct()


def _matrix(table: pa.Table) -> np.ndarray:
    flat = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(table.num_rows, len(flat) // table.num_rows)


def scores(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of x and of y, as int64."""
    most = int(np.abs(x).max(initial=0)) * int(np.abs(y).max(initial=0)) * max(1, x.shape[1])
    if most < 1 << 53:
        return (x.astype(np.float64) @ y.T.astype(np.float64)).astype(np.int64)
    if most < 1 << 63:
        return x @ y.T
    raise ArithmeticError("an inner product may not fit a 64-bit number")


def best_of(who: np.ndarray, slot: np.ndarray, ids: np.ndarray, s: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the k best, by score and then id, of each (who, slot)."""
    order = np.lexsort((ids, -s, slot, who))
    who, slot = who[order], slot[order]
    begin = np.flatnonzero(np.concatenate([[True], (who[1:] != who[:-1]) | (slot[1:] != slot[:-1])])) if len(order) else np.zeros(0, dtype=np.int64)
    nth = np.arange(len(order)) - np.repeat(begin, np.diff(np.append(begin, len(order))))
    return order[nth < k]


def _cell(k: int, slots_of):
    """A cell's best rows: ``slots_of(anchors, at, rows, s)`` gives the slot of
    each (row, anchor) of a chunk, 0 where the row is not wanted."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [(np.zeros(0, dtype=np.int64),) * 4]
        if left.num_rows and right.num_rows:
            x, y = _matrix(right), _matrix(left)
            ids, anchor = right["id"].to_numpy(), left["id"].to_numpy()
            for lo in range(0, len(y), CHUNK):
                at = slice(lo, lo + CHUNK)
                s = scores(x, y[at])
                slot = slots_of(left, at, right, s)
                slot[ids[:, None] == anchor[at][None, :]] = 0
                row, col = np.nonzero(slot)
                found = (anchor[at][col], slot[row, col], ids[row], s[row, col])
                best = best_of(*found, k)
                out.append(tuple(f[best] for f in found))
        who, slot, ids, s = (np.concatenate(p) for p in zip(*out, strict=True))
        return pa.table({"anchor_id": pa.array(who, pa.int64()), "slot": pa.array(slot, pa.int32()), "vec_id": pa.array(ids, pa.int64()), "score": pa.array(s, pa.int64())})

    return run


def _same_label(anchors: pa.Table, at: slice, rows: pa.Table, s: np.ndarray) -> np.ndarray:
    """Slot 1: the rows of the anchor's label."""
    return (rows["code"].to_numpy()[:, None] == anchors["code"].to_numpy()[at][None, :]).astype(np.int32)


def _limit_slots(anchors: pa.Table, at: slice, rows: pa.Table, s: np.ndarray) -> np.ndarray:
    """Of rows of other labels, the number of the anchor's limits that admit the score."""
    limits, least = anchors["limits"].to_pylist()[at], anchors["least"].to_numpy()[at]
    other = rows["code"].to_numpy()[:, None] != anchors["code"].to_numpy()[at][None, :]
    wanted = other & (s >= least[None, :])
    slot = np.zeros(s.shape, dtype=np.int32)
    for j, own in enumerate(limits):
        rise = np.sort(np.array(own, dtype=np.int64))
        slot[:, j] = len(rise) - np.searchsorted(rise, s[:, j], side="left")
    return np.where(wanted, slot, 0)


def _searched(anchors: DataFrame, rows: DataFrame, blocks: int, groups: int, k: int, slots_of) -> DataFrame:
    """The k best rows of each anchor's slots."""
    here = lambda seed, n: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    a = anchors.withColumn("grp", here(1, groups)).withColumn("block", every(blocks))
    a = a.select(*(F.col(c).alias(c) for c in a.columns))  # both sides come from the same rows
    r = rows.withColumn("block", here(2, blocks)).withColumn("grp", every(groups))
    key = ["dim", "block", "grp"]
    found = a.groupBy(*key).cogroup(r.groupBy(*key)).applyInArrow(_cell(k, slots_of), PAIR)
    order = W.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    once = found.groupBy("anchor_id", "slot", "vec_id").agg(F.max("score").alias("score"))  # ids with several vectors
    return once.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k)


def mine(df: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         scale: int = SCALE, id_column: str = "vec_id", label: Column | str = "label", vector: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score; is_anchor is a condition on the column ``id``."""
    label = F.col(label) if isinstance(label, str) else label
    rows = usable(df, label, id_column, vector, scale).select("id", F.xxhash64("label").alias("code"), "v", F.size("v").alias("dim"))
    rows = stored(rows, "negatives-rows")
    n_rows, n_anchors = rows.agg(F.count("*"), F.count_if(is_anchor)).first()
    blocks, groups = max(1, math.ceil(n_rows / BLOCK)), max(1, math.ceil(n_anchors / GROUP))
    anchors = rows.filter(is_anchor)

    found = _searched(anchors, rows, blocks, groups, positives, _same_label).filter("score >= 0")
    limits = found.select("anchor_id", "nth", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
                          F.expr(f"(score * {low} + 99) div 100").alias("lowest"), F.expr(f"score * {high} div 100").alias("limit"))
    place = F.row_number().over(W.partitionBy("anchor_id").orderBy("nth"))  # limits fall as places rise
    limits = stored(limits.filter("lowest <= limit").withColumn("place", place).drop("nth"), "negatives-positives")

    windows = limits.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list("limit").alias("limits"), F.min("lowest").alias("least"))
    best = stored(_searched(anchors.join(windows, "id"), rows, blocks, groups, negatives, _limit_slots), "negatives-slots")
    # Descending slots are descending scores: the suffix of a positive's slots is one ordered list.
    answers = limits.join(best.select("anchor_id", "slot", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")), "anchor_id")
    order = W.partitionBy("anchor_id", "place").orderBy(F.desc("negative_score"), "negative_id")
    answers = answers.filter((F.col("slot") >= F.col("place")) & (F.col("negative_score") >= F.col("lowest")))
    answers = answers.groupBy("anchor_id", "place", "positive_id", "positive_score", "negative_id").agg(F.max("negative_score").alias("negative_score"))
    answers = answers.withColumn("rank", F.row_number().over(order))
    return answers.filter(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

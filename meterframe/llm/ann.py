"""Approximate nearest neighbours with a hash-prefix forest.

Each of ``TREES`` trees keeps the vectors of a block sorted by a string of
``BITS`` random-hyperplane bits.  A query descends in every tree to its longest
matching prefix, and then ascends in all trees together, one bit at a time,
until the prefix ranges together hold ``CANDIDATE_SHARE`` times the block's
vectors (a vector counts once for each tree that finds it) and one of them holds
``LEAST_CANDIDATES``.  Candidates are scored exactly.

Rows are dealt to blocks of about ``BLOCK`` vectors by a hash of the id, queries
to groups of about ``QUERY_GROUP``; one task holds one block and one group, and
the best of all blocks are merged.  Every row is indexed.  Equal vectors of a
block share one place in the forest, so a very common vector uses up neither
the candidate budget nor time, and all its ids can be returned.

Edge cases: vectors that are null, empty or zero, or hold null or non-finite
components, take no part, neither as queries nor as candidates; nor do rows
with a null id; vectors only meet vectors of their own length; rows that repeat
an id and a vector count once; equal scores are ordered by the smaller id; a
query with fewer than k candidates returns them all; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import by_value

by_value(__name__)

TREES = 64
BITS = 20
CANDIDATE_SHARE = 0.75
LEAST_CANDIDATES = 100
BLOCK = 8192
QUERY_GROUP = 1024
SEED = 20

CELL = "id long, embedding array<double>"


class Forest:
    """Sorted arrays of hash strings over the distinct rows of x."""

    def __init__(self, x: np.ndarray, planes: np.ndarray):
        self.x = x
        self.planes = planes
        hashed = self.hashes(x)
        self.order = [np.argsort(h, kind="stable") for h in hashed]
        self.sorted = [h[o] for h, o in zip(hashed, self.order, strict=True)]

    def hashes(self, x: np.ndarray) -> np.ndarray:
        weight = (1 << np.arange(BITS - 1, -1, -1)).astype(np.int64)
        return np.stack([((x @ p) > 0) @ weight for p in self.planes])

    def candidates(self, q: np.ndarray, share: float):
        """For each query the candidate rows: ranges of the longest common
        prefix length at which all trees together hold enough rows."""
        hashed = self.hashes(q)
        least = min(LEAST_CANDIDATES, len(self.x))
        low = np.zeros((TREES, len(q)), dtype=np.int64)
        high = np.zeros((TREES, len(q)), dtype=np.int64)
        open_ = np.arange(len(q))
        for depth in range(BITS, -1, -1):
            rest = (1 << (BITS - depth)) - 1
            for t in range(TREES):
                h = hashed[t, open_]
                low[t, open_] = np.searchsorted(self.sorted[t], h & ~rest, side="left")
                high[t, open_] = np.searchsorted(self.sorted[t], h | rest, side="right")
            held = high[:, open_] - low[:, open_]
            open_ = open_[(held.sum(axis=0) < share * len(self.x)) | (held.max(axis=0) < least)]
            if not len(open_):
                break
        for i in range(len(q)):
            mark = np.zeros(len(self.x), dtype=bool)
            for t in range(TREES):
                mark[self.order[t][low[t, i] : high[t, i]]] = True
            yield np.flatnonzero(mark)


def _matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False) if n else np.zeros(0)
    return np.asarray(flat, dtype=float).reshape(n, -1)


def search_cell(queries: pa.Table, rows: pa.Table, k: int, share: float) -> pa.Table:
    """The k best rows of one block for each query of one group."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if queries.num_rows and rows.num_rows:
        q_id, q = queries["id"].to_numpy(), _matrix(queries["embedding"], queries.num_rows)
        r_id, r = rows["id"].to_numpy(), _matrix(rows["embedding"], rows.num_rows)
        r, place = np.unique(r, axis=0, return_inverse=True)
        pairs = np.unique(np.stack([place.ravel(), r_id], axis=1), axis=0)  # (vector, id), once each
        ids, first = pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(r) + 1))
        planes = np.random.default_rng(SEED).normal(size=(TREES, r.shape[1], BITS))
        for i, found in enumerate(Forest(r, planes).candidates(q, share)):
            s = r[found] @ q[i]
            if len(s) > k + 1:
                keep = s >= np.partition(s, len(s) - k - 1)[len(s) - k - 1]  # the query itself may be among them
                found, s = found[keep], s[keep]
            own = [ids[first[j] : first[j + 1]][: k + 1] for j in found]  # ids ascend: no later one can be among the k best
            who = np.concatenate(own) if own else np.zeros(0, dtype=np.int64)
            s = np.repeat(s, [len(o) for o in own])
            other = who != q_id[i]
            who, s = who[other], s[other]
            best = np.lexsort((who, -s))[:k]
            out.append((np.full(len(best), q_id[i]), who[best], s[best]))
    a, b, c = (np.concatenate(p) for p in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    return pa.table({"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(c, pa.float64())})


def clean(df: DataFrame, id_column: str, vector: str) -> DataFrame:
    """Rows that take part."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return df.filter(F.col(id_column).isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)).select(
        F.col(id_column).cast("long").alias("id"), v.cast("array<double>").alias("embedding")
    )


def nearest(df: DataFrame, is_query: Column, k: int, id_column: str = "vec_id", vector: str = "embedding", share: float = CANDIDATE_SHARE) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows found for each query row
    (is_query is a condition on the column ``id``)."""
    rows = clean(df, id_column, vector)
    queries = rows.filter(is_query)
    n_rows, n_queries = rows.agg(F.count("*"), F.count_if(is_query)).first()
    blocks, groups = max(1, math.ceil(n_rows / BLOCK)), max(1, math.ceil(n_queries / QUERY_GROUP))
    here = lambda seed, n: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    cell = [F.size("embedding").alias("dim"), "block", "grp", "id", "embedding"]
    q = queries.dropDuplicates().withColumn("grp", here(1, groups)).withColumn("block", every(blocks)).select(*cell)
    r = rows.withColumn("block", here(2, blocks)).withColumn("grp", every(groups)).select(*cell)
    key = ["dim", "block", "grp"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return search_cell(left, right, k, share)

    found = q.groupBy(*key).cogroup(r.groupBy(*key)).applyInArrow(run, "query_id long, vec_id long, score double")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

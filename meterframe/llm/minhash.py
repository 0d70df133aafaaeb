"""Near-duplicate documents by min-max hashing.

Every document's set of word shingles is hashed by ``PERMUTATIONS`` linear
permutations, and both the minimum and the maximum under each are kept, so one
evaluation gives two signature values.  ``BANDS`` bands of ``ROWS`` values are
bucket keys; two documents at the threshold miss every bucket with probability
``(1 - s**ROWS)**BANDS`` (3e-7 at 0.85).  Links are confirmed on full sets.

Documents with equal sets form one class, and only class representatives are
compared.  Within a bucket members are compared with its smallest member
first, then with another member those that are in another component still.
What is left in buckets of several components is joined exactly: shingles are
ordered by rarity among these documents, and two documents of different
components meet if they share a shingle of their prefixes, behind the length
and position filters; of the pairs found each document's most promising one is
compared first, for some rounds, and then all that still join two components
(at once where at most ``FEW_PAIRS`` are left: a round is some fifty shuffles).
So no link that matters for the components is lost, and
neither a bucket of near copies (a few comparisons a member) nor one of
documents just below the threshold (whose prefixes are their own shingles)
costs all pairs.

Edge cases: null, empty and wordless texts have no shingles and are linked with
nothing; a text with fewer words than a shingle is one shingle; very long
texts are read whole; rows that repeat an id each get a row, with the
component's smallest id; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import textops
from .common import by_value, small, stored
from .graph import components

by_value(__name__)

PERMUTATIONS = 96
ROWS = 6
BANDS = 2 * PERMUTATIONS // ROWS
PICK_ROUNDS = 3  # rounds of one pair for each document before all open pairs
FEW_PAIRS = 200_000  # open pairs that cost less to confirm at once than in rounds
HUB_ROUNDS = 2  # rounds of one hub for each bucket before the exact join
SEED = 1


def signatures(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows that have shingles, band keys of each) of distinct shingles."""
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else np.zeros(0, dtype=np.int64)
    rng = np.random.default_rng(SEED)
    factor = rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shift = rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)
    bands = np.zeros((len(first), BANDS), dtype=np.uint64)
    if len(first):
        for p in range(PERMUTATIONS):
            v = h * factor[p] + shift[p]
            for half, value in enumerate((np.minimum.reduceat(v, first), np.maximum.reduceat(v, first))):
                band = (2 * p + half) // ROWS
                bands[:, band] = textops.mix(bands[:, band] * np.uint64(0x9E3779B97F4A7C15) + value + np.uint64(band + 1))
    return row[first], bands


def _sketch(shingle: int, id_name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 36
        for b in batches:
            offsets, data = textops.columns(b.column(2))
            for lo, hi in textops.runs(offsets):
                row, h = textops.distinct(*textops.shingles(textops.words(offsets[lo : hi + 1], data), shingle))
                n = np.bincount(row, minlength=hi - lo)
                have, bands = signatures(row, h)
                f = np.zeros((2, hi - lo), dtype=np.uint64)
                if len(have):
                    first = np.cumsum(n) - n
                    for k, salt in enumerate((0x243F6A8885A308D3, 0x13198A2E03707344)):
                        f[k][have] = np.add.reduceat(textops.mix(h ^ np.uint64(salt)), first[have])
                width = np.zeros(hi - lo, dtype=np.int64)
                width[have] = BANDS
                keys = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(width)]).astype(np.int32)), pa.array(textops.signed(bands.ravel())))
                yield pa.record_batch(
                    [pa.array(np.arange(uid + lo, uid + hi)), b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(textops.signed(f[0])), pa.array(textops.signed(f[1])), keys],
                    names=["uid", "id", "t", "n", "f1", "f2", "bands"],
                )
            uid += b.num_rows
        textops.release()

    return run


def _confirm(shingle: int, percent: int):
    """Pairs (a, b, text_a, text_b) whose sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            off_a, data_a = textops.columns(b.column(2))
            off_b, data_b = textops.columns(b.column(3))
            for lo, hi in textops.runs(off_a + off_b):
                ra, ha = textops.distinct(*textops.shingles(textops.words(off_a[lo : hi + 1], data_a), shingle))
                rb, hb = textops.distinct(*textops.shingles(textops.words(off_b[lo : hi + 1], data_b), shingle))
                row, h = np.concatenate([ra, rb]), np.concatenate([ha, hb])
                order = np.lexsort((h, row))
                row, h = row[order], h[order]
                both = np.bincount(row[1:][(row[1:] == row[:-1]) & (h[1:] == h[:-1])], minlength=hi - lo)
                union = np.bincount(row, minlength=hi - lo) - both
                keep = pa.array((100 * both >= percent * union) & (union > 0))
                yield pa.record_batch([b.column(0).slice(lo, hi - lo).filter(keep), b.column(1).slice(lo, hi - lo).filter(keep)], names=["a", "b"])
        textops.release()

    return run


def _shingle_rows(shingle: int):
    """Of (uid, root, text): a row for each distinct shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            offsets, data = textops.columns(b.column(2))
            for lo, hi in textops.runs(offsets):
                row, h = textops.distinct(*textops.shingles(textops.words(offsets[lo : hi + 1], data), shingle))
                n = np.bincount(row, minlength=hi - lo)
                at = pa.array(row + lo)
                yield pa.record_batch([b.column(0).take(at), b.column(1).take(at), pa.array(textops.signed(h)), pa.array(n[row], pa.int64())], names=["uid", "root", "h", "n"])
        textops.release()

    return run


def prefix_pairs(texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pairs (a, b) of different roots among (uid, root, text) that can reach
    the similarity: they share a shingle of their prefixes (an exact filter).
    shared counts the prefix shingles that the two were seen to share."""
    rows = stored(texts.select("uid", "root", "text").mapInArrow(_shingle_rows(shingle), "uid long, root long, h long, n long"), "open-shingles")
    common = rows.groupBy("h").agg(F.count("*").alias("df"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    common = common.withColumn("mixed", F.col("lo") < F.col("hi")).select("h", "df", "mixed")
    order = W.partitionBy("uid").orderBy("df", "h")
    placed = rows.join(common, "h").withColumn("place", F.row_number().over(order))
    longest = F.expr(f"n - ({percent} * n + 99) div 100 + 1")
    met = stored(placed.filter(F.col("mixed") & (F.col("place") <= longest)).select("h", "uid", "root", "n", "place"), "open-prefixes")
    overlap = F.expr(f"({percent} * (x.n + y.n) + {99 + percent}) div {100 + percent}")
    pairs = met.alias("x").join(
        met.alias("y"),
        (F.col("x.h") == F.col("y.h"))
        & (F.col("x.root") < F.col("y.root"))
        & (100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n"))
        & (1 + F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place")) >= overlap),
    )
    return pairs.groupBy(F.least("x.uid", "y.uid").alias("a"), F.greatest("x.uid", "y.uid").alias("b")).agg(F.count("*").alias("shared"))


def link(df: DataFrame, shingle: int = 5, percent: int = 80, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_shingles, component_id of every row: documents are linked when
    100 * intersection >= percent * union of their shingle sets."""
    id_type = dict(df.dtypes)[id_column]
    docs = df.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("t"), F.col(text).alias("text"))
    sketches = stored(
        docs.mapInArrow(_sketch(shingle, id_column), f"uid long, id {id_type}, t long, n long, f1 long, f2 long, bands array<long>"), "sketches"
    )
    classes = stored(
        sketches.filter("n > 0").groupBy("n", "f1", "f2").agg(F.min("uid").alias("rep"), F.min("id").alias("least_id")), "classes"
    )
    reps = sketches.join(classes.select(F.col("rep").alias("uid")), "uid", "left_semi")
    buckets = reps.select("uid", "n", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1").select("bucket")
    members = stored(buckets.join(shared, "bucket"), "members")  # of buckets with two members or more

    def texts_of(ids: DataFrame) -> DataFrame:
        """ids (uid, ...) with their texts."""
        wanted = stored(sketches.select("uid", F.col("id").alias("_id"), F.col("t").alias("_t")).join(ids, "uid"), "wanted")
        return docs.join(small(wanted), F.col("id").eqNullSafe(F.col("_id")) & (F.col("t") == F.col("_t"))).drop("id", "t", "_id", "_t")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        """The links among pairs (a, b)."""
        ids = pairs.select(F.col("a").alias("uid")).unionAll(pairs.select(F.col("b").alias("uid"))).distinct()
        texts = stored(texts_of(ids).dropDuplicates(["uid"]), "texts")
        joined = pairs.join(texts.select(F.col("uid").alias("a"), F.col("text").alias("text_a")), "a").join(
            texts.select(F.col("uid").alias("b"), F.col("text").alias("text_b")), "b"
        )
        return stored(joined.select("a", "b", "text_a", "text_b").mapInArrow(_confirm(shingle, percent), "a long, b long"), name)

    def rooted(frame: DataFrame, column: str, name: str) -> DataFrame:
        """frame with the root of its column so far (a document without links is its own)."""
        known = roots.select(F.col("id").alias(column), F.col("root").alias(name))
        return frame.join(known, column, "left").withColumn(name, F.coalesce(name, column))

    def apart_now() -> DataFrame:
        """Members of buckets that hold several components."""
        known = rooted(members, "uid", "root")
        split = known.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("bucket")
        return stored(known.join(split, "bucket"), "apart")

    # One hub for each bucket: its smallest member, then its smallest by another order.
    tested = links = roots = None
    for turn in range(HUB_ROUNDS):
        apart = apart_now() if turn else members.withColumn("root", F.col("uid"))
        order = F.xxhash64("uid", F.lit(turn)) if turn else F.col("uid")
        hubs = apart.groupBy("bucket").agg(F.min_by(F.struct("uid", "root", "n"), order).alias("hub"))
        pairs = apart.join(hubs, "bucket").filter(
            (F.col("hub.root") != F.col("root")) & (100 * F.least("hub.n", "n") >= percent * F.greatest("hub.n", "n"))
        )
        pairs = pairs.select(F.least("hub.uid", "uid").alias("a"), F.greatest("hub.uid", "uid").alias("b")).distinct()
        pairs = stored(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        found = verified(pairs, "links")
        tested = pairs if tested is None else tested.unionAll(pairs)
        links = found if links is None else links.unionAll(found)
        roots = stored(components(links), "roots")

    # What is apart still, exactly: the best pair of each document, then all.
    open_pairs = prefix_pairs(texts_of(apart_now().select("uid", "root").distinct()), shingle, percent)
    open_pairs = stored(open_pairs.join(tested, ["a", "b"], "left_anti"), "open-pairs")
    for turn in range(PICK_ROUNDS + 1):
        left = rooted(rooted(open_pairs, "a", "ra"), "b", "rb").filter("ra != rb").select("a", "b", "shared")
        left = open_pairs = stored(left, "open-pairs")
        count = left.count()
        if not count:
            break
        every = turn == PICK_ROUNDS or count <= FEW_PAIRS
        if every:
            pairs = left.select("a", "b")
        else:
            best = lambda x, y: left.groupBy(F.col(x)).agg(F.max(F.struct("shared", F.col(y).alias("o"))).alias("m")).select(F.col(x), F.col("m.o").alias(y))  # noqa: B023, E731
            pairs = stored(best("a", "b").unionByName(best("b", "a")).distinct(), "pairs")
            open_pairs = left.join(pairs, ["a", "b"], "left_anti")
        links = links.unionAll(verified(pairs, "links"))
        roots = stored(components(links), "roots")
        if every:
            break
    named = classes.join(roots.withColumnRenamed("id", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_class = named.join(least, "root").select("n", "f1", "f2", "component_id")
    return sketches.select("id", "n", "f1", "f2").join(of_class, ["n", "f1", "f2"], "left").select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")
    )

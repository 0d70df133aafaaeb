"""Near-duplicate documents by SimHash with deletion-variant signatures.

A document's fingerprint has a bit set where more than half of the XXH64 hashes
(seed 42) of its word shingles, repeats included, have it set.  Two documents
are linked when their fingerprints differ in at most ``radius`` bits.

A fingerprint is cut into ``radius // 2 + 1`` segments, so few that two linked
fingerprints differ by at most one bit in one of them.  Each segment is indexed
under its variants: one for each of its bits, with that bit deleted.  Segments
that differ by at most one bit share a variant, so an equality join on
(segment, deleted bit, other bits) meets every linked pair, and the full
distance verifies it.  A pair that shares several variants is taken at one of
them only: the first segment that is close enough, at the bit that differs, or
at bit 0 if none does.

Only distinct fingerprints are joined; equal ones are one node already.  A
bucket of more than ``bucket_limit`` fingerprints is not paired.  Its members
go, with all of theirs, through an exact way that costs 65 rows each (for a
radius of 2): every fingerprint is put down at itself and at all points one bit
away.  Two fingerprints at most two bits apart have a point in common, and all
that meet at a point are at most two bits apart, so they are one clique, tied
to its smallest by an aggregate.  So neither path makes all pairs of a group.

Edge cases: null, empty and wordless texts have fingerprint 0, which is linked
like any other; a text with fewer words than a shingle is one shingle; very
long texts are read whole; rows that repeat an id each get a row, and are linked
by their own texts; a null id gets a row and never names a component that has
another id; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import textops
from .common import by_value, stored
from .graph import components

by_value(__name__)

BITS = 64
RADIUS = 2
BUCKET_LIMIT = 128  # pairing a larger bucket costs each member more than its 65 points

_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)
_LANES = np.uint64(0x0101010101010101)


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def xxh64(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of every data[start:end], all ranges at once."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    wide = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))
    half = np.ndarray(len(data) + 1, dtype="<u4", buffer=padded, strides=(1,))
    size = end - start
    h = np.full(len(start), (seed + int(_P5)) & 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    at = start.copy()
    if len(long_ := np.flatnonzero(size >= 32)):
        begin = (seed + int(_P1) + int(_P2), seed + int(_P2), seed, seed - int(_P1))
        v = [np.full(len(long_), x & 0xFFFFFFFFFFFFFFFF, dtype=np.uint64) for x in begin]
        pos, left = at[long_], size[long_] // 32
        todo = np.arange(len(long_))
        while len(todo):
            for i in range(4):
                v[i][todo] = _rotl(v[i][todo] + wide[pos[todo] + 8 * i] * _P2, 31) * _P1
            pos[todo] += 32
            left[todo] -= 1
            todo = todo[left[todo] > 0]
        g = _rotl(v[0], 1) + _rotl(v[1], 7) + _rotl(v[2], 12) + _rotl(v[3], 18)
        for x in v:
            g = (g ^ (_rotl(x * _P2, 31) * _P1)) * _P1 + _P4
        h[long_], at[long_] = g, pos
    h += size.astype(np.uint64)
    for width, step in ((8, lambda g, p: _rotl(g ^ (_rotl(wide[p] * _P2, 31) * _P1), 27) * _P1 + _P4),
                        (4, lambda g, p: _rotl(g ^ (half[p].astype(np.uint64) * _P1), 23) * _P2 + _P3),
                        (1, lambda g, p: _rotl(g ^ (padded[p].astype(np.uint64) * _P5), 11) * _P1)):
        todo = np.flatnonzero(end - at >= width)
        while len(todo):
            h[todo] = step(h[todo], at[todo])
            at[todo] += width
            todo = todo[end[todo] - at[todo] >= width]
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def shingle_ranges(text: bytes, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends): the words, lower-cased (A-Z) and joined by single
    spaces, and the byte range of each run of k words, or of all, if fewer."""
    plain = np.frombuffer(b" ".join(text.lower().split()), dtype=np.uint8)
    none = np.zeros(0, dtype=np.int64)
    if not len(plain):
        return plain, none, none
    gaps = np.flatnonzero(plain == 0x20)
    start, end = np.append(0, gaps + 1), np.append(gaps, len(plain))
    k = min(k, len(start))
    return plain, start[: len(start) - k + 1], end[k - 1 :]


def majority(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A fingerprint for each document, whose n hashes follow one another in h.

    A byte lane holds the sum of one bit over at most 255 hashes, so eight
    additions count all 64 bits."""
    out = np.zeros(len(n), dtype=np.uint64)
    have = np.flatnonzero(n)
    if not len(have):
        return out
    last = np.cumsum(n)[have]
    first = last - n[have]
    pieces = (n[have] + 254) // 255
    owner = np.cumsum(pieces) - pieces
    piece = np.repeat(first, pieces) + 255 * (np.arange(pieces.sum()) - np.repeat(owner, pieces))
    for bit in range(8):
        lanes = np.add.reduceat((h >> np.uint64(bit)) & _LANES, piece).view(np.uint8).reshape(-1, 8)
        ones = np.add.reduceat(lanes, owner, axis=0, dtype=np.int64)
        on = (2 * ones > n[have][:, None]).astype(np.uint64)
        out[have] |= (on << (np.arange(8, dtype=np.uint64) * np.uint64(8) + np.uint64(bit))).sum(axis=1, dtype=np.uint64)
    return out


def _prints(shingle: int):
    """Of (id, text): (id, print), runs of texts of about a chunk at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            offsets, data = textops.columns(b.column(1))
            out = np.zeros(b.num_rows, dtype=np.uint64)
            for lo, hi in textops.runs(offsets):
                parts = [shingle_ranges(data[offsets[i] : offsets[i + 1]].tobytes(), shingle) for i in range(lo, hi)]
                base = np.cumsum([0, *(len(p[0]) for p in parts[:-1])])
                start = np.concatenate([p[1] + at for p, at in zip(parts, base, strict=True)])
                end = np.concatenate([p[2] + at for p, at in zip(parts, base, strict=True)])
                h = xxh64(np.concatenate([p[0] for p in parts]), start, end)
                out[lo:hi] = majority(h, np.array([len(p[1]) for p in parts]))
            yield pa.record_batch([b.column(0), pa.array(textops.signed(out))], names=["id", "print"])

    return run


def fingerprints(df: DataFrame, shingle: int = 3, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, print) of every row."""
    kind = dict(df.dtypes)[id_column]
    return df.select(F.col(id_column).alias("id"), F.col(text).alias("text")).mapInArrow(_prints(shingle), f"id {kind}, print long")


def _long(bits: int) -> Column:
    """64 bits as Spark's long."""
    return F.lit(bits - (1 << BITS) if bits >> (BITS - 1) else bits)


def segments(radius: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of the segments."""
    n = radius // 2 + 1
    edges = [i * BITS // n for i in range(n + 1)]
    return [(lo, hi - lo) for lo, hi in zip(edges, edges[1:], strict=False)]


def _cut(x: Column, lo: int, width: int) -> Column:
    return F.shiftrightunsigned(x, lo).bitwiseAND(_long((1 << width) - 1))


def variants(x: Column, radius: int) -> Column:
    """array<struct<cell, rest>> of a fingerprint: the number of (segment,
    deleted bit), and the segment without that bit."""
    out = []
    for s, (lo, width) in enumerate(segments(radius)):
        for i in range(width):
            rest = _cut(x, lo, width).bitwiseAND(_long((1 << BITS) - 1 - (1 << i)))
            out.append(F.struct(F.lit(s * BITS + i).alias("cell"), rest.alias("rest")))
    return F.array(*out)


def _taken_here(a: Column, b: Column, cell: Column, radius: int) -> Column:
    """Whether the pair is to be taken at this of the variants it shares."""
    here, close_before = F.lit(False), F.lit(False)
    for s, (lo, width) in enumerate(segments(radius)):
        apart = _cut(a.bitwiseXOR(b), lo, width)
        bit = F.when(apart == 0, F.lit(0))
        for i in range(width):
            bit = bit.when(apart == _long(1 << i), F.lit(i))
        here = here | (~close_before & (cell == bit + s * BITS))
        close_before = close_before | (F.bit_count(apart) <= 1)
    return F.coalesce(here, F.lit(False))


def points(x: Column) -> Column:
    """A fingerprint and all that differ from it in one bit."""
    return F.array(x, *(x.bitwiseXOR(_long(1 << i)) for i in range(BITS)))


def links(prints: DataFrame, radius: int = RADIUS, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """(a, b) links among distinct fingerprints (one column, print): all of
    small buckets, and of larger ones links that tie the same components."""
    if radius not in (1, 2):
        raise ValueError("the way of large buckets is exact for a radius of 1 or 2")
    spread = prints.select("print", F.inline(variants(F.col("print"), radius)))
    bucket = W.partitionBy("cell", "rest")  # its rows are numbers, and travel once
    members = stored(spread.withColumn("members", F.count("*").over(bucket)).filter("members > 1"), "simhash-members")
    few = members.filter(F.col("members") <= bucket_limit).select("cell", "rest", "print")
    near = few.alias("x").join(
        few.alias("y"),
        (F.col("x.cell") == F.col("y.cell")) & (F.col("x.rest") == F.col("y.rest")) & (F.col("x.print") < F.col("y.print"))
        & (F.bit_count(F.col("x.print").bitwiseXOR(F.col("y.print"))) <= radius)
        & _taken_here(F.col("x.print"), F.col("y.print"), F.col("x.cell"), radius),
    ).select(F.col("x.print").alias("a"), F.col("y.print").alias("b"))
    many = members.filter(F.col("members") > bucket_limit).select("print").distinct()
    if radius == 2:
        at = many.select("print", F.explode(points(F.col("print"))).alias("point"))
        tied = at.join(at.groupBy("point").agg(F.min("print").alias("least"), F.max("print").alias("most")).filter("least < most").drop("most"), "point")
    else:  # one bit apart: two points in common, of which one is a fingerprint itself
        at = many.select("print", F.explode(points(F.col("print"))).alias("point"))
        tied = at.join(many.select(F.col("print").alias("least")), F.col("point") == F.col("least"))
    tied = tied.filter("least != print").select(F.col("least").alias("a"), F.col("print").alias("b"))
    return near.unionAll(tied).distinct()


def link(df: DataFrame, shingle: int = 3, radius: int = RADIUS, bucket_limit: int = BUCKET_LIMIT, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id, print (long), component_id of every row."""
    rows = stored(fingerprints(df, shingle, id_column, text), "simhash-prints")
    nodes = stored(rows.groupBy("print").agg(F.min("id").alias("least_id")), "simhash-nodes")
    roots = components(stored(links(nodes.select("print"), radius, bucket_limit), "simhash-links"))
    named = nodes.join(roots.withColumnRenamed("id", "print"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_print = named.select("print", "root").join(least, "root").select("print", "component_id")
    return rows.join(of_print, "print", "left").select(F.col("id").alias(id_column), "print", "component_id")

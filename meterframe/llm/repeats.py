"""Removal of long repeated byte strings by distributed prefix doubling.

Every byte that lies in a string of ``LENGTH`` bytes which also starts anywhere
else is removed.  Which of all such strings repeat is found by ranking
positions by ever longer strings and keeping only those that are not unique
yet.  Ranks are named by 64-bit fingerprints of the bytes, so that the rank at
any offset is computed where the text is; Spark groups the rank pairs.

* Positions are not all ranked: each string of ``LENGTH`` bytes is represented
  by its anchor, the leftmost of its ``BLOCK``-byte blocks with the smallest
  fingerprint, which depends on the string's bytes alone.  Equal strings have
  equal anchors at equal offsets, and a run of neighbouring strings shares one.
* Round 1 ranks anchors by their block.  Unique anchors drop out, with all
  their strings.
* Round 2 pairs that rank with the rank of the anchor's whole run (up to
  ``LENGTH + SPAN - 1`` bytes): runs that occur twice are settled as repeated.
* Round 3 does the same with ``NODE`` neighbouring strings of the runs still
  open: the bytes common to them must repeat, or they are settled as unique.
* Round 4 ranks the single strings of what is open then.

A round sends one representative of equal runs only.  Between rounds the open
ranks travel as a bitmap of fixed size, which may let more through, never less.

Edge cases: null and empty texts have no bytes; texts shorter than LENGTH keep
all; very long texts are cut into overlapping parts that together see every
string; strings never cross documents; rows that repeat an id and a text are
documents of their own, and all of both is removed if long enough; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops
from .common import FILTER_BITS, by_value, key_filter, maybe_in, stored

by_value(__name__)

LENGTH = 200
BLOCK = 64
SPAN = LENGTH - BLOCK + 1  # blocks in a string, and so strings in a run at most
NODE = 12
INDEX_BITS = 22
PART = 1 << 19  # strings handled together


def parts(offsets: np.ndarray, length: int = LENGTH) -> Iterator[tuple[int, int, int, int]]:
    """(first document, end document, first byte, end byte): runs of documents,
    or overlapping parts of a document that is longer than PART."""
    for lo, hi in textops.runs(offsets, PART):
        begin, end = int(offsets[lo]), int(offsets[hi])
        while end - begin > PART + length:
            yield lo, hi, begin, begin + PART + length - 1
            begin += PART
        yield lo, hi, begin, end


class Runs:
    """The runs of a part: anchor, first and last string start (in the part),
    fingerprints, and document of each."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray, lo: int, hi: int, begin: int, end: int):
        raw = data[begin:end]
        self.begin = begin
        self.sums = textops.poly(raw)
        cut = np.clip(offsets[lo : hi + 1] - begin, 0, len(raw))
        n = len(raw) - LENGTH + 1
        if n <= 0:
            self.anchor = self.first = self.last = self.doc = np.zeros(0, dtype=np.int64)
            self.block = np.zeros(0, dtype=np.uint64)
            return
        at = np.arange(len(raw) - BLOCK + 1)
        block = textops.poly_range(self.sums, at, at + BLOCK)
        mask = np.uint64((1 << INDEX_BITS) - 1)
        packed = (block & ~mask) | at.astype(np.uint64)
        padded = np.concatenate([packed, np.full((-len(packed)) % SPAN, np.uint64(0xFFFFFFFFFFFFFFFF))]).reshape(-1, SPAN)
        ahead = np.minimum.accumulate(padded, axis=1).ravel()
        behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
        anchor = (np.minimum(behind[:n], ahead[SPAN - 1 : SPAN - 1 + n]) & mask).astype(np.int64)
        size = np.diff(cut)
        doc = np.repeat(np.arange(hi - lo), size)
        inside = np.zeros(n, dtype=bool)
        start = np.arange(n)
        inside[:] = doc[:n] == doc[LENGTH - 1 : LENGTH - 1 + n]
        start = start[inside]
        anchor = anchor[inside]
        fresh = np.ones(len(start), dtype=bool)
        fresh[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
        head = np.flatnonzero(fresh)
        self.anchor, self.first = anchor[head], start[head]
        self.last = start[np.append(head[1:], len(start))[: len(head)] - 1] if len(head) else start[:0]
        self.doc = doc[self.first] + lo
        self.block = block[self.anchor]

    def name(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return textops.poly_range(self.sums, start, end)

    def keys(self, k: np.ndarray, place: np.ndarray) -> np.ndarray:
        """A key of a place in a document whose low FILTER_BITS bits depend on
        the document alone."""
        low = np.uint64((1 << FILTER_BITS) - 1)
        doc = textops.mix(k.view(np.uint64))
        return (textops.mix(doc + textops.mix(place.astype(np.uint64) + np.uint64(1))) & ~low) | (doc & low)

    def nodes(self, pick: np.ndarray):
        """(run, number, first, last, core) of the nodes of the runs picked."""
        base = self.anchor[pick] - (SPAN - 1)
        a, b = (self.first[pick] - base) // NODE, (self.last[pick] - base) // NODE
        count = b - a + 1
        run = np.repeat(np.arange(len(pick)), count)
        number = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count) + a[run]
        low = base[run] + number * NODE
        first, last = np.maximum(low, self.first[pick][run]), np.minimum(low + NODE - 1, self.last[pick][run])
        core = textops.mix(self.name(low + NODE - 1, low + LENGTH) + number.astype(np.uint64))
        return pick[run], number, first, last, core


def place_key(key: str):
    """The part of a place key that depends on the place."""
    return F.shiftrightunsigned(key, FILTER_BITS)


def _places(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(FILTER_BITS)).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (k, text): the block rank of every run, with its count in the part."""
    for b in batches:
        offsets, data = textops.columns(b.column(1))
        for part in parts(offsets):
            c, n = np.unique(Runs(offsets, data, *part).block, return_counts=True)
            yield pa.record_batch([pa.array(textops.signed(c)), pa.array(n)], names=["c", "n"])


def _row(c, u, key, k, first, last):
    arrays = [textops.signed(c), textops.signed(u), textops.signed(key), k, first.astype(np.int32), last.astype(np.int32)]
    return pa.record_batch([pa.array(x) for x in arrays], names=["c", "u", "key", "k", "first", "last"])


ROW = "c long, u long, key long, k long, first int, last int"


def _ranked(open_blocks, docs=None, runs=None, nodes=None):
    """Of (k, text): rank pairs of whole runs (round 2), of their nodes if the
    bitmap of open runs is given (round 3), of single strings if that of open
    nodes is given too (round 4)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = open_blocks.value
        for b in batches:
            if docs is not None:
                doc = textops.mix(np.ascontiguousarray(b.column(0).to_numpy()).view(np.uint64))
                b = b.filter(pa.array(maybe_in(docs.value, textops.signed(doc))))
            offsets, data = textops.columns(b.column(1))
            ks = np.ascontiguousarray(b.column(0).to_numpy())
            for part in parts(offsets):
                r = Runs(offsets, data, *part)
                pick = np.flatnonzero(maybe_in(blocks, textops.signed(r.block)))
                k = ks[r.doc[pick]]
                at = r.begin - offsets[r.doc[pick]]
                key = r.keys(k, r.first[pick] + at)
                if runs is None:
                    yield _row(r.block[pick], r.name(r.first[pick], r.last[pick] + LENGTH), key, k, r.first[pick] + at, r.last[pick] + at)
                    continue
                pick = pick[maybe_in(runs.value, _places(key))]
                owner, number, first, last, core = r.nodes(pick)
                k, at = ks[r.doc[owner]], r.begin - offsets[r.doc[owner]]
                key = r.keys(k, first + at)
                if nodes is None:
                    yield _row(core, r.name(first, last + LENGTH), key, k, first + at, last + at)
                    continue
                some = maybe_in(nodes.value, _places(key))
                first, last, k, at = first[some], last[some], k[some], at[some]
                count = last - first + 1
                which = np.repeat(np.arange(len(first)), count)
                start = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + first[which]
                h = r.name(start, start + LENGTH)
                yield _row(h, h, np.zeros(len(h), dtype=np.uint64), k[which], start + at[which], start + at[which])

    return run


def _settle(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(settled, open): rows whose rank u occurs twice, and one place key for
    each rank pair whose c occurs twice without all its u doing so."""
    pairs = stored(rows.groupBy("c", "u").agg(F.count("*").alias("n"), F.min("key").alias("key")), f"{name}-pairs")
    groups = pairs.groupBy("c").agg(F.sum("n").alias("total"), F.min("n").alias("least"))
    open_keys = pairs.join(groups.filter("total > 1 AND least = 1").select("c"), "c").select("key")
    settled = rows.join(pairs.filter("n > 1").select("c", "u"), ["c", "u"]).select("k", "first", "last")
    return settled, stored(open_keys, f"{name}-open")


def repeated_ranges(df: DataFrame) -> DataFrame:
    """(k, first, last): string starts of (k, text) that repeat, as ranges."""
    sc = df.sparkSession.sparkContext
    counted = df.mapInArrow(_blocks, "c long, n long").groupBy("c").agg(F.sum("n").alias("n"))
    blocks = sc.broadcast(key_filter(counted.filter("n > 1").select("c")))
    settled, docs, runs, nodes = [], None, None, None
    for name in ("runs", "nodes", "strings"):
        rows = stored(df.mapInArrow(_ranked(blocks, docs, runs, nodes), ROW), name)
        done, open_keys = _settle(rows, name)
        settled.append(done)
        if name != "strings":
            open_places = sc.broadcast(key_filter(open_keys.select(place_key("key").alias("key"))))
            docs = sc.broadcast(key_filter(open_keys.select("key")))
            runs, nodes = (open_places, None) if name == "runs" else (runs, open_places)
    return settled[0].unionAll(settled[1]).unionAll(settled[2])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (id, text, ranges): lengths, removed runs and the digest of the rest."""
    for b in batches:
        offsets, data = textops.columns(b.column(1))
        spans = b.column(2)
        if spans.null_count:
            spans = spans.fill_null([])
        edge = spans.offsets.to_numpy()
        flat = spans.values
        first, last = (np.asarray(flat.field(i).to_numpy(zero_copy_only=False), dtype=np.int64) for i in (0, 1))
        n_bytes, n_removed, n_spans, digests = [], [], [], []
        for i in range(b.num_rows):
            raw = data[offsets[i] : offsets[i + 1]]
            gone, runs = 0, 0
            if edge[i + 1] > edge[i]:
                order = np.argsort(first[edge[i] : edge[i + 1]], kind="stable") + edge[i]
                a, z = first[order], np.maximum.accumulate(last[order] + LENGTH)
                fresh = np.concatenate([[True], a[1:] > z[:-1]])
                head = np.flatnonzero(fresh)
                a, z = a[head], z[np.append(head[1:], len(z)) - 1]
                gone, runs = int((z - a).sum()), len(a)
                keep = np.zeros(len(raw) + 1, dtype=np.int32)
                keep[a] += 1
                keep[z] -= 1
                raw = raw[np.cumsum(keep[:-1]) == 0]
            n_bytes.append(int(offsets[i + 1] - offsets[i]))
            n_removed.append(gone)
            n_spans.append(runs)
            digests.append(hashlib.sha256(raw.tobytes()).hexdigest())
        yield pa.record_batch(
            [b.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(digests, pa.string())],
            names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def keyed(df: DataFrame, id_column: str, text: str) -> DataFrame:
    """id, k, text: k is a hash of the id and the whole text."""
    return df.select(F.col(id_column).alias("id"), F.xxhash64(id_column, text).alias("k"), F.col(text).alias("text"))


def removal_ranges(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(k, ranges): byte ranges of string starts to remove, for each document
    that has any."""
    docs = keyed(df, id_column, text)
    ranges = repeated_ranges(docs.select("k", "text"))
    return ranges.groupBy("k").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))


def _may_have_ranges(held):
    """Of (id, k, text): the rows of documents that may have ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(maybe_in(held.value, b.column(1).to_numpy())))

    return run


def _uncut(held):
    """Of (id, k, text): the results of documents that have no ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
        few = (b.filter(pa.array(~maybe_in(held.value, b.column(1).to_numpy()))) for b in batches)
        yield from _cut(pa.record_batch([b.column(0), b.column(2), pa.nulls(b.num_rows, kind)], names=["id", "text", "ranges"]) for b in few)

    return run


def digest(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 of every row.  Only texts
    that may lose something are shuffled to meet their ranges."""
    id_type = dict(df.dtypes)[id_column]
    docs = keyed(df, id_column, text)
    ranges = stored(removal_ranges(df, id_column, text), "ranges")
    held = df.sparkSession.sparkContext.broadcast(key_filter(ranges.select("k")))
    schema = f"id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    some = docs.mapInArrow(_may_have_ranges(held), f"id {id_type}, k long, text string")
    cut = some.join(ranges, "k", "left").select("id", "text", "ranges").mapInArrow(_cut, schema)
    return docs.mapInArrow(_uncut(held), schema).unionAll(cut).withColumnRenamed("id", id_column)

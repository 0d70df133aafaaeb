"""Vectorised text kernels for Arrow batches.

Everything works on the UTF-8 bytes of a whole Arrow string column at once:
separators, ASCII lower-casing, word boundaries and word hashes are numpy
array operations, so no Python object is made per word.  Memory is bounded by
cutting a batch into runs of documents of about ``CHUNK`` bytes (a longer
document is one run of its own).
"""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
import sys
import types
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK = 1 << 19

_SEP = np.zeros(256, dtype=bool)
_SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def worker_state(name: str) -> dict:
    """A dict kept by the Python worker process across its tasks (for caches of
    bounded size).  It lives outside this module, which every task gets anew."""
    holder = sys.modules.get("_meterframe_worker_state")
    if holder is None:
        holder = sys.modules["_meterframe_worker_state"] = types.ModuleType("_meterframe_worker_state")
    return holder.__dict__.setdefault(name, {})


def release() -> None:
    """Give freed memory back, which an idle Python worker would keep."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # no such call on this machine
        ctypes.CDLL(None).malloc_trim(0)


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept and grown by doubling."""
    powers = worker_state("powers")
    have = powers.get(name)
    if have is None or len(have) < n:
        size = max(CHUNK, 1 << int(n - 1).bit_length() if n > 1 else 1)
        out = np.ones(size, dtype=np.uint64)
        done = 1
        step = base
        while done < size:
            out[done : 2 * done] = out[:done] * step
            step = np.uint64((int(step) * int(step)) & 0xFFFFFFFFFFFFFFFF)
            done *= 2
        powers[name] = have = out
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


class Words(NamedTuple):
    """Words of a run of documents, in order."""

    row: np.ndarray  # document of each word, counted within the run
    start: np.ndarray  # byte range of each word in data
    end: np.ndarray
    hash: np.ndarray  # uint64 hash of the lower-cased word
    n_docs: int


def columns(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (int64) and bytes of a string column; a null counts as empty."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    if text.null_count:
        text = text.fill_null("")
    wide = pa.types.is_large_string(text.type) or pa.types.is_large_binary(text.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = text.buffers()
    n = len(text)
    if n == 0:
        return np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    off = np.frombuffer(offsets, dtype=kind, count=n + 1, offset=text.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, dtype=np.uint8)
    return off - off[0], raw


def runs(offsets: np.ndarray, chunk: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of documents of at most ``chunk`` bytes, or of one document."""
    n, at = len(offsets) - 1, 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + chunk, side="right")) - 1
        to = min(n, max(at + 1, to))
        yield at, to
        at = to


def poly(data: np.ndarray) -> np.ndarray:
    """Prefix sums of the polynomial hash; poly_range gives a range's hash."""
    out = np.empty(len(data) + 1, dtype=np.uint64)
    out[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("base", _BASE, len(data)), out=out[1:])
    return out


def poly_range(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-independent 64-bit hash of data[start:end], mixed with its length."""
    h = (sums[end] - sums[start]) * _power("inverse", _INVERSE, len(sums))[start]
    return mix(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


LONG_WORD = 256
_MASKS = np.array([(1 << (8 * i)) - 1 for i in range(9)], dtype=np.uint64)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each data[start:end], eight bytes at a time; a word of
    more than LONG_WORD bytes is hashed on its own."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    at = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))
    size = end - start
    h = mix((at[start] & _MASKS[np.minimum(size, 8)]) + size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    more, done = np.flatnonzero((size > 8) & (size <= LONG_WORD)), 8
    while len(more):
        block = at[start[more] + done] & _MASKS[np.minimum(size[more] - done, 8)]
        h[more] = mix(h[more] * np.uint64(0xD6E8FEB86659FD93) + block)
        done += 8
        more = more[size[more] > done]
    for i in np.flatnonzero(size > LONG_WORD):
        h[i] = int.from_bytes(hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    return h


def words(offsets: np.ndarray, data: np.ndarray) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of documents data[offsets[i]:offsets[i+1]]."""
    n_docs = len(offsets) - 1
    base = int(offsets[0])
    cut = offsets - base
    data = data[base : int(offsets[-1])]
    n = len(data)
    inside = np.zeros(n + 2, dtype=bool)
    inside[1:-1] = ~_SEP[data]
    change = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = change[::2], change[1::2]
    edge = np.unique(cut[1:-1])
    edge = edge[(edge > 0) & (edge < n)]
    edge = edge[inside[edge] & inside[edge + 1]]  # a word on both sides: it ends and another starts
    if len(edge):
        start, end = np.sort(np.concatenate([start, edge])), np.sort(np.concatenate([end, edge]))
    row = np.searchsorted(cut, start, side="right") - 1
    return Words(row, start, end, word_hashes(_LOWER[data], start, end), n_docs)


_MIXERS = np.array(
    [0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB],
    dtype=np.uint64,
)


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every k-word shingle, repeats included; a document
    with fewer words, but at least one, has its whole word sequence as one."""
    n = len(w.hash)
    count = np.bincount(w.row, minlength=w.n_docs)
    begin = np.cumsum(count) - count
    if n >= k:
        h = np.zeros(n - k + 1, dtype=np.uint64)
        for j in range(k):
            h += w.hash[j : n - k + 1 + j] * _MIXERS[j % len(_MIXERS)] + np.uint64(j)
            h ^= h >> np.uint64(29)
        whole = w.row[: n - k + 1] == w.row[k - 1 :]
        row, h = w.row[: n - k + 1][whole], mix(h[whole])
    else:
        row, h = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        at = begin[short]
        s = np.zeros(len(short), dtype=np.uint64)
        for j in range(k - 1):
            has = count[short] > j
            step = s + w.hash[np.minimum(at + j, n - 1)] * _MIXERS[j % len(_MIXERS)] + np.uint64(j)
            s = np.where(has, step ^ (step >> np.uint64(29)), s)
        s = mix(s ^ mix(count[short].astype(np.uint64) + np.uint64(977)))
        row, h = np.concatenate([row, short]), np.concatenate([h, s])
        order = np.argsort(row, kind="stable")
        row, h = row[order], h[order]
    return row, h


def grouped_order(row: np.ndarray, n_rows: int, *keys: tuple[np.ndarray, int]) -> np.ndarray:
    """Order by document and then by the leading bits of each key (values,
    bits), packed into one 64-bit word so that a single sort does it."""
    left = 64 - max(1, int(n_rows).bit_length())
    word = row.astype(np.uint64) << np.uint64(left)
    for values, bits in keys:
        take = min(bits, left)
        left -= take
        word |= (values >> np.uint64(bits - take)) << np.uint64(left)
    return np.argsort(word)


def distinct(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, hash), ordered by document and leading hash bits."""
    if not len(h):
        return row, h
    order = grouped_order(row, int(row.max()) + 1, (h, 64))
    row, h = row[order], h[order]
    keep = np.ones(len(h), dtype=bool)
    keep[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return row[keep], h[keep]


def lines(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(line offsets, document of each line) of documents split at newlines;
    every document has at least one line, which may be empty."""
    base, end = int(offsets[0]), int(offsets[-1])
    after = np.flatnonzero(data[base:end] == 10) + base + 1
    start = np.concatenate([offsets[:-1], after])
    doc = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, after - 1, side="right") - 1])
    order = np.lexsort((doc, start))
    return np.append(start[order], end), doc[order]


def signed(h: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return np.ascontiguousarray(h).view(np.int64)

"""BPE encoding and decoding with a word-end vocabulary.

A vocabulary file of the tokenizers library is read on the driver and
broadcast: its size is fixed by the file.  Encoding follows the file:
special tokens are cut out of the raw text, the rest is NFC-normalised,
lower-cased character by character, and split into contractions, letter runs,
single digits and runs of other signs.  The bytes of a piece become symbols;
the last one carries the word-end mark.  Symbols form a doubly linked list,
merge candidates wait in a priority queue ordered by (rank, position), and an
entry whose symbols have changed since it was queued is skipped as stale.
Decoding joins the vocabulary strings with single spaces, as the file names no
decoder.

Edge cases: a null or empty text gives no ids and an empty decoded text;
very long texts are processed whole, piece by piece; repeated rows repeat;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, fresh
from .textops import release, worker_state

by_value(__name__)

#: Words whose ids a worker keeps; the rest is encoded again when met again.
CACHE_WORDS = 400_000

# Fixed values of the vocabulary file's pre-tokenizer: white space, and the
# pieces that a text is split into.
SPACE = r"\t-\r \x85\xa0  -     　"
PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{SPACE}\p{{L}}\p{{N}}]+"


def load(path: str) -> dict:
    """The parts of a vocabulary file that encoding needs."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    return {
        "vocab": model["vocab"],
        "merges": [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]],
        "suffix": model["end_of_word_suffix"] or "",
        "special": {t["content"]: t["id"] for t in spec["added_tokens"]},
    }


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if it is a
    visible Latin-1 character, else the next code point from 256 on."""
    out, extra = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


def lowered(text: str) -> str:
    """Lower-cased one character at a time (a final sigma is no exception)."""
    return "".join(map(str.lower, text)) if "Σ" in text else text.lower()


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, spec: dict):
        vocab = spec["vocab"]
        self.special = spec["special"]
        self.strings = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for s, i in [*vocab.items(), *self.special.items()]:
            self.strings[i] = s
        symbols = byte_symbols()
        self.inner = [vocab.get(s) for s in symbols]
        self.final = [vocab.get(s + spec["suffix"]) for s in symbols]
        self.merges = {}
        for rank, (a, b) in enumerate(spec["merges"]):
            if a in vocab and b in vocab and a + b in vocab:
                self.merges.setdefault((vocab[a] << 20) | vocab[b], (rank, vocab[a + b]))
        self.pieces = regex.compile(PIECES)
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.cache: dict[str, bytes] = {}

    def merge(self, ids: list[int]) -> list[int]:
        """Merge symbols by rank: queue of (rank, place, merged id, left, right)."""
        n, merges = len(ids), self.merges
        if n < 2:
            return ids
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            found = merges.get((ids[i] << 20) | ids[i + 1])
            if found is not None:
                queue.append((found[0], i, found[1], ids[i], ids[i + 1]))
        heapq.heapify(queue)
        while queue:
            _, i, new, left, right = heapq.heappop(queue)
            j = nxt[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # stale: one of the two symbols has been merged since
            ids[i], ids[j] = new, -1
            k = nxt[i] = nxt[j]
            if k < n:
                prv[k] = i
                if (found := merges.get((new << 20) | ids[k])) is not None:
                    heapq.heappush(queue, (found[0], i, found[1], new, ids[k]))
            h = prv[i]
            if h >= 0 and (found := merges.get((ids[h] << 20) | new)) is not None:
                heapq.heappush(queue, (found[0], h, found[1], ids[h], new))
        return [x for x in ids if x >= 0]

    def piece(self, piece: str) -> list[int]:
        raw = piece.encode()
        ids = [self.inner[b] for b in raw[:-1]] + [self.final[raw[-1]]]
        return self.merge([i for i in ids if i is not None])

    def _kept(self, piece: str) -> bytes:
        out = b"".join(i.to_bytes(4, "little") for i in self.piece(piece))
        if len(piece) <= 64:
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            self.cache[piece] = out
        return out

    def parts(self, text: str) -> Iterator[bytes]:
        """The little-endian ids of each piece in order."""
        for segment in self.cut.split(text) if self.cut else [text]:
            if segment in self.special:
                yield self.special[segment].to_bytes(4, "little")
            elif segment:
                plain = segment if segment.isascii() else unicodedata.normalize("NFC", segment)
                get = self.cache.get
                for p in self.pieces.findall(lowered(plain)):
                    yield get(p) or self._kept(p)

    def encode(self, text: str | None) -> list[int]:
        raw = b"".join(self.parts(text or ""))
        return list(memoryview(raw).cast("I")) if raw else []

    def decode(self, ids) -> str:
        return " ".join([self.strings[i] for i in ids])

    def digests(self, text: str | None) -> tuple[int, str, str]:
        ids = b"".join(self.parts(text or ""))
        decoded = self.decode(memoryview(ids).cast("I"))
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def worker_codec(spec, key: str) -> Codec:
    """The worker's codec for this vocabulary, with its cache of words."""
    kept = worker_state("bpe")
    if key not in kept:
        kept.clear()
        kept[key] = Codec(spec.value)
    return kept[key]


def encode_columns(df: DataFrame, columns: dict[str, str], path: str, text: str = "text") -> DataFrame:
    """The columns (name: type) with n_tokens and ids array<int> of the text."""
    spec = df.sparkSession.sparkContext.broadcast(load(path))
    names = list(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(spec, path)
        for b in batches:
            raw = [b"".join(codec.parts(t.as_py() or "")) for t in b.column(len(names))]
            n = np.array([len(r) // 4 for r in raw], dtype=np.int64)
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(np.frombuffer(b"".join(raw), dtype="<i4")))
            yield pa.record_batch([*(b.column(i) for i in range(len(names))), pa.array(n), ids], names=[*names, "n_tokens", "ids"])
        release()

    schema = ", ".join([*(f"`{n}` {t}" for n, t in columns.items()), "n_tokens long, ids array<int>"])
    return df.select(*names, F.col(text).alias(fresh("_text", names))).mapInArrow(run, schema)


def decode_ids(df: DataFrame, columns: dict[str, str], path: str, ids: str = "ids") -> DataFrame:
    """The columns (name: type) with the decoded string of the ids."""
    spec = df.sparkSession.sparkContext.broadcast(load(path))
    names = list(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(spec, path)
        for b in batches:
            texts = [codec.decode(i or []) for i in b.column(len(names)).to_pylist()]
            yield pa.record_batch([*(b.column(i) for i in range(len(names))), pa.array(texts, pa.string())], names=[*names, "decoded"])

    schema = ", ".join([*(f"`{n}` {t}" for n, t in columns.items()), "decoded string"])
    return df.select(*names, F.col(ids).alias(fresh("_ids", names))).mapInArrow(run, schema)


def digest_documents(df: DataFrame, path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256 of every text: the ids are the
    encoder's, the decoded text joins the strings of those ids."""
    spec = df.sparkSession.sparkContext.broadcast(load(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(spec, path)
        for b in batches:
            got = [codec.digests(t.as_py()) for t in b.column(1)]
            yield pa.record_batch(
                [b.column(0), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.string()), pa.array([g[2] for g in got], pa.string())],
                names=[id_column, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return df.select(id_column, text).mapInArrow(
        run, f"{id_column} {dict(df.dtypes)[id_column]}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )

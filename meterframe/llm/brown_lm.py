"""LM scoring with a Brown class-based bigram model.

Every training word has a class of its own, whatever its rank, in two steps.
Seed: the exchange algorithm assigns symbols to ``CLASSES`` classes; each symbol
in turn moves to the class that raises the class-bigram likelihood most.  One of
the ``TOP_WORDS`` most frequent training words is its own symbol, any other word
shares the symbol of its ending (``SHAPES`` hash slots of its last three bytes),
and the end of a text is a symbol and a class of its own.  Then every other
training word takes, from the seed classes counted before and after all of its
own occurrences, the class that makes them likeliest; its ending's class weighs
as ``ENDING_WEIGHT`` occurrences.  Only words never seen in training keep the
class of their ending.  Transitions and emissions are counted on these classes;
where two words meet that both are not among the ``HEAD_WORDS`` most frequent,
each counts half a transition, the other taken with its ending's class.
The score of a text is

    sum over tokens of log10 P(class | previous class) + log10 P(word | class)

with transitions interpolated with the class unigram, and emissions
``(c + 0.5) / (N_class + 0.5 (V_class + 1))``, where the one added type stands
for all unknown words of the class.  Both factors sum to one.

Counts cover all training texts, and grow with them.  The counts and classes of
the ``HEAD_WORDS`` most frequent words are broadcast (a fixed bound); every rarer
token of a text is shuffled and joined with all other training words and their
classes, whatever their number.

Edge cases: a null or empty text is one end token; very long texts are read
whole; repeated rows, also with the same id, stay separate rows; ties in
frequency go to the smaller word, ties between classes to the smaller class;
with no training text every token is unknown and the base score is 0; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, stored

by_value(__name__)

HEAD_WORDS = 1 << 17
TOP_WORDS = 767
SHAPES = 256
CLASSES = 64
SWEEPS = 6
END = b""  # no word is empty
TRANSITION_WEIGHT = 20.0  # pseudo-count of the class unigram in a transition
ENDING_WEIGHT = 2.0  # occurrences that a word's ending counts for in the choice of its class
FLUSH_WORDS = 300_000
FLUSH_TOKENS = 1 << 20
SYMBOLS = 1 + TOP_WORDS + SHAPES
RANGE = 1 << 11  # frequent words whose neighbours are counted together
SPREAD = 8  # first-level groups of these counts
ROWS = "uid long, seq binary, tail array<struct<word:binary,at:array<int>>>"

def tokens(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words ``[^\\x20\\x09-\\x0D]+``, without the end token."""
    return text.encode().lower().split() if text else []


def shape(word: bytes) -> int:
    return 1 + TOP_WORDS + zlib.crc32(word[-3:]) % SHAPES


class Lookup(dict):
    """word -> value; an absent word gives what ``other`` makes of it."""

    def __init__(self, known, other):
        super().__init__(known)
        self.other = other

    def __missing__(self, word):
        return self.other(word)


def count_words(df: DataFrame) -> DataFrame:
    """(word, n) over all texts, the end token included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out():
            batch = pa.record_batch([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
            seen.clear()
            return batch

        for b in batches:
            for t in b.column(0):
                seen.update(tokens(t.as_py()))
                seen[END] += 1
                if len(seen) > FLUSH_WORDS:
                    yield out()
        if seen:
            yield out()

    return df.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def encode(df: DataFrame, words: list[bytes], values: np.ndarray, text: str, id_column: str | None = None, counts: np.ndarray | None = None, ends: int = 0) -> DataFrame:
    """Of each text: (uid, seq, tail).  seq holds values[i] of each token, where
    i is its rank, or len(words) + shape of any other word; tail has these other
    words and their places.  With counts also the id, n_tokens and, of the
    frequent words and the end, n_head and head, the sum of log10(count + 0.5)."""
    sc = df.sparkSession.sparkContext
    kept = sc.broadcast((words, values, counts, ends))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, value, count, n_ends = kept.value
        n_head = len(known)
        place = Lookup({w: i for i, w in enumerate(known)}, lambda w: n_head + shape(w))
        if count is not None:
            log_count = np.concatenate([np.log10(count + 0.5), np.zeros(SYMBOLS)])  # rarer words are joined later
            end_log = float(np.log10(n_ends + 0.5))
        first = TaskContext.get().partitionId() << 36
        for b in batches:
            seqs, n_tokens, n_known, in_head = [], [], [], []
            rare_words, n_places, places, n_rare = [], [], [], []
            for t in b.column(0):
                own = tokens(t.as_py())
                at = np.array([*map(place.__getitem__, own)], dtype=np.int64)
                seqs.append(value[at].tobytes())
                tail: dict[bytes, list[int]] = {}
                rare = np.flatnonzero(at >= n_head).tolist()
                for i in rare:
                    tail.setdefault(own[i], []).append(i)
                rare_words.extend(tail)
                n_rare.append(len(tail))
                for v in tail.values():
                    n_places.append(len(v))
                    places.extend(v)
                if count is not None:
                    n_tokens.append(len(own) + 1)
                    n_known.append(len(own) - len(rare) + (n_ends > 0))
                    in_head.append(float(log_count[at].sum()) + end_log)
            offsets = lambda n: pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets(n_places), pa.array(places, pa.int32()))
            items = pa.StructArray.from_arrays([pa.array(rare_words, pa.binary()), lists], ["word", "at"])
            uid = np.arange(first, first + b.num_rows)
            first += b.num_rows
            columns, names = [pa.array(uid), pa.array(seqs, pa.binary()), pa.ListArray.from_arrays(offsets(n_rare), items)], ["uid", "seq", "tail"]
            if count is not None:
                columns += [b.column(1), pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(in_head, pa.float64())]
                names += ["id", "n_tokens", "n_head", "head"]
            yield pa.record_batch(columns, names=names)

    if counts is None:
        return df.select(text).mapInArrow(run, ROWS)
    return df.select(text, id_column).mapInArrow(run, f"{ROWS}, id {dict(df.dtypes)[id_column]}, n_tokens long, n_head long, head double")


def joined_texts(column: pa.Array, dtype, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, starts): the sequences of a batch in one, an end before the
    first and behind each; starts has the place of each text's first token."""
    raw = column.cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = raw.buffers()[2]
    flat = np.frombuffer(data if data is not None else b"", dtype=np.uint8)[offsets[0] : offsets[-1]].view(dtype)
    n = np.diff(offsets) // np.dtype(dtype).itemsize
    starts = np.cumsum(n) - n + np.arange(len(n)) + 1
    out = np.full(len(flat) + len(n) + 1, end, dtype=np.int64)
    out[np.arange(len(flat)) + np.repeat(np.arange(len(n)) + 1, n)] = flat
    return out, starts


def bigrams(df: DataFrame, sequences, size: int) -> np.ndarray:
    """Counts of neighbours, size x size, in all arrays that ``sequences`` makes
    of the batches of df.  Tasks send one row for each pair they met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, dtype=np.int64)
        for s in sequences(batches):
            for lo in range(0, len(s) - 1, FLUSH_TOKENS):  # neighbouring pieces share one token
                part = s[lo : lo + FLUSH_TOKENS + 1]
                total += np.bincount(part[:-1] * size + part[1:], minlength=len(total))
        cell = np.flatnonzero(total)
        yield pa.record_batch([pa.array(cell), pa.array(total[cell])], names=["cell", "n"])

    summed = df.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size * size, dtype=np.int64)
    out[summed["cell"].to_numpy()] = summed["n"].to_numpy()
    return out.reshape(size, size)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(pairs: np.ndarray, classes: int, sweeps: int) -> np.ndarray:
    """Class of each symbol.  The end symbol keeps class 0 for itself; the
    others start dealt out by frequency and move one at a time."""
    n = len(pairs)
    weight = pairs.sum(axis=0) + pairs.sum(axis=1)
    order = np.argsort(-weight[1:], kind="stable") + 1
    mine = np.zeros(n, dtype=np.int64)
    mine[order] = 1 + np.arange(n - 1) % (classes - 1)
    one = np.zeros((n, classes))
    one[np.arange(n), mine] = 1
    left = pairs @ one  # symbol -> class counts
    right = pairs.T @ one  # class -> symbol counts, by symbol
    grid = one.T @ left
    for _ in range(sweeps):
        moved = 0
        for s in order:
            if not weight[s]:
                continue
            a = mine[s]
            self_n = float(pairs[s, s])
            out, into = left[s].copy(), right[s].copy()
            out[a] -= self_n
            into[a] -= self_n
            grid[a] -= out
            grid[:, a] -= into
            grid[a, a] -= self_n
            rows, cols = grid.sum(axis=1), grid.sum(axis=0)
            gain = (_xlogx(grid + out[None, :]) - _xlogx(grid)).sum(axis=1) + (_xlogx(grid + into[:, None]) - _xlogx(grid)).sum(axis=0)
            d = np.diag(grid)
            gain += _xlogx(d + out + into + self_n) - _xlogx(d) - (_xlogx(d + out) - _xlogx(d)) - (_xlogx(d + into) - _xlogx(d))
            gain -= _xlogx(rows + out.sum() + self_n) - _xlogx(rows) + _xlogx(cols + into.sum() + self_n) - _xlogx(cols)
            gain[0] = -np.inf
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            mine[s] = b
            grid[b] += out
            grid[:, b] += into
            grid[b, b] += self_n
            if b != a:
                moved += 1
                left[:, a] -= pairs[:, s]
                left[:, b] += pairs[:, s]
                right[:, a] -= pairs[s]
                right[:, b] += pairs[s]
        if not moved:
            break
    return mine


def head_words(vocabulary: DataFrame) -> tuple[list[bytes], np.ndarray]:
    """Frequent words and their counts, most frequent first: as many whole
    steps of frequency, from the top, as hold at most HEAD_WORDS words.  The
    steps (16 for each doubling) bring a bounded histogram to the driver."""
    step = F.floor(16 * F.log2("n"))
    known = vocabulary.filter(F.col("word") != END)
    total, lowest = 0, None
    for at, words in sorted(known.groupBy(step.alias("at")).count().collect(), reverse=True):
        if total + words > HEAD_WORDS:
            break
        total, lowest = total + words, at
    if lowest is None:
        return [], np.zeros(0, dtype=np.int64)
    head = known.filter(step >= lowest).toArrow()
    words, counts = head["word"].to_pylist(), head["n"].to_numpy()
    order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
    return [words[i] for i in order], counts[order]


def transitions(grid: np.ndarray) -> np.ndarray:
    """log10 P(class | class before) of counts of neighbouring classes."""
    share = (grid.sum(axis=0) + 1) / (grid.sum() + CLASSES)
    return np.log10((grid + TRANSITION_WEIGHT * share) / (grid.sum(axis=1, keepdims=True) + TRANSITION_WEIGHT))


def evidence(grid: np.ndarray) -> np.ndarray:
    """What one occurrence between two seed classes says for each class: row
    l * CLASSES + r is log P(class | l) + log P(r | class) - log N(class).  The
    end's class is open to no word."""
    t = transitions(grid)
    out = t[:, None, :] + t.T[None, :, :] - np.log10(grid.sum(axis=0) + 1)
    out[:, :, 0] = -np.inf
    return out.reshape(CLASSES * CLASSES, CLASSES)


def ending_evidence(grid: np.ndarray, ending: int) -> np.ndarray:
    """The evidence of ENDING_WEIGHT occurrences of a class as the seed has it."""
    before, after = grid[:, ending], grid[ending]
    e = evidence(grid).reshape(CLASSES, CLASSES, CLASSES)[:, :, 1:]
    out = np.full(CLASSES, -np.inf)
    p, q = before / max(before.sum(), 1), after / max(after.sum(), 1)
    out[1:] = ENDING_WEIGHT * np.einsum("l,r,lrb->b", p, q, e)
    return out


def squeeze(values: np.ndarray, sorted_: bool = True) -> bytes:
    """Numbers as bytes, sorted ones by their steps."""
    steps = np.diff(values, prepend=0) if sorted_ else values
    kind = np.uint32 if len(steps) and steps.max() < 1 << 32 else np.int64
    return bytes([kind is np.uint32, len(steps) == 0]) + pa.compress(steps.astype(kind).tobytes() or b"0", codec="zstd", asbytes=True) + (len(steps) * np.dtype(kind).itemsize).to_bytes(8, "little")


def spread_out(raw: bytes, sorted_: bool = True) -> np.ndarray:
    """The numbers of squeeze."""
    if raw[1]:
        return np.zeros(0, dtype=np.int64)
    plain = pa.decompress(raw[2:-8], int.from_bytes(raw[-8:], "little"), codec="zstd", asbytes=True)
    values = np.frombuffer(plain, dtype=np.uint32 if raw[0] else np.int64).astype(np.int64)
    return np.cumsum(values) if sorted_ else values


def frequent_classes(encoded: DataFrame, n_head: int, seed: np.ndarray, grid: np.ndarray, endings: np.ndarray) -> np.ndarray:
    """Class of each frequent word behind the first TOP_WORDS, by rank.  Tasks
    send their occurrences as numbers, packed by range of ranks; these are added
    up in two levels."""
    sc = encoded.sparkSession.sparkContext
    kept = sc.broadcast((seed, evidence(grid), endings))
    pairs = CLASSES * CLASSES

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, task = kept.value[0], TaskContext.get().partitionId() % SPREAD
        for b in batches:
            ids, _ = joined_texts(b.column(0), np.int32, len(of) - 1)
            at = np.flatnonzero((ids >= TOP_WORDS) & (ids < n_head))
            if not len(at):
                continue
            code = np.sort(ids[at] * pairs + of[ids[at - 1]] * CLASSES + of[ids[at + 1]])
            part = code // (RANGE * pairs)
            which, first = np.unique(part, return_index=True)
            packed = [squeeze(code[s:e] % (RANGE * pairs)) for s, e in zip(first, np.append(first[1:], len(code)), strict=True)]
            yield pa.record_batch([pa.array(which.astype(np.int32)), pa.array(np.full(len(which), task, dtype=np.int32)), pa.array(packed, pa.binary())], names=["part", "salt", "codes"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for part, salt, codes in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                got = total.setdefault((part, salt), np.zeros((2, RANGE * CLASSES), dtype=np.int64))
                code = spread_out(codes)
                word, left, right = code // pairs * CLASSES, code // CLASSES % CLASSES, code % CLASSES
                got[0] += np.bincount(word + left, minlength=RANGE * CLASSES)
                got[1] += np.bincount(word + right, minlength=RANGE * CLASSES)
        for (part, _), got in total.items():
            cell = np.flatnonzero(got)
            yield pa.record_batch([pa.array([part], pa.int32()), pa.array([squeeze(cell)], pa.binary()), pa.array([squeeze(got.ravel()[cell], sorted_=False)], pa.binary())], names=["part", "cells", "counts"])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for part, cells, counts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                got = total.setdefault(part, np.zeros((2, RANGE, CLASSES), dtype=np.int64))
                got.ravel()[spread_out(cells)] += spread_out(counts, sorted_=False)
        for part, (left, right) in total.items():
            ranks = part * RANGE + np.flatnonzero(left.any(axis=1))
            chosen = best(left[ranks % RANGE], right[ranks % RANGE], kept.value[1], kept.value[2][ranks])
            yield pa.record_batch([pa.array(ranks, pa.int64()), pa.array(chosen, pa.int64())], names=["rank", "class"])

    sent = encoded.select("seq").mapInArrow(send, "part int, salt int, codes binary").repartition("part", "salt")
    found = sent.mapInArrow(add, "part int, cells binary, counts binary").repartition("part").mapInArrow(choose, "rank long, class long").toPandas()
    out = np.full(n_head, -1, dtype=np.int64)
    out[found["rank"].to_numpy()] = found["class"].to_numpy()  # at most HEAD_WORDS rows
    return out


def best(left: np.ndarray, right: np.ndarray, says: np.ndarray, ending: np.ndarray) -> np.ndarray:
    """The likeliest class of words, given counts of the classes before and
    after them (a row a word) and what their endings say."""
    says = says.reshape(CLASSES, CLASSES, CLASSES)[:, :, 1:]
    # Evidence is a sum of a part for the class before and one for that after.
    base = says[0, 0]
    before, after = says[:, 0] - base, says[0] - base
    total = left @ before + right @ after + left.sum(axis=1, keepdims=True) * base + ending[:, 1:]
    return 1 + np.argmax(np.round(total, 9), axis=1)


def rare_classes(encoded: DataFrame, n_head: int, seed: np.ndarray, class_of: np.ndarray, grid: np.ndarray, slots: np.ndarray) -> DataFrame:
    """(word, n, class) of all training words that are not frequent, and rows
    without a word: n half transitions in cell ``class`` of the class grid, of
    all pairs that hold such a word.  A task reads its words in order, so it
    holds one batch and what one word's occurrences add up to."""
    says = evidence(grid).reshape(CLASSES, CLASSES, CLASSES)
    says[:, :, 0] = -1e9
    base = says[0, 0]
    kept = encoded.sparkSession.sparkContext.broadcast((seed, class_of, base + says[:, 0] - base, says[0] - base, slots))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, final = kept.value[:2]
        for b in batches:
            ids, starts = joined_texts(b.column(0), np.int32, len(first) - 1)
            tail = b.column(1)
            row = np.repeat(np.arange(len(tail)), tail.value_lengths().to_numpy())
            items = tail.flatten()
            word, places = items.field(0), items.field(1)
            n = places.value_lengths().to_numpy()
            at = np.repeat(starts[row], n) + places.flatten().to_numpy()
            code = np.zeros(len(at), dtype=np.int64)
            for near in (ids[at - 1], ids[at + 1]):
                rare = (near >= n_head) & (near < len(first) - 1)
                code = ((code * CLASSES + first[near]) * CLASSES + final[near]) * 2 + rare
            offsets = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
            yield pa.record_batch([word, pa.ListArray.from_arrays(offsets, pa.array(code.astype(np.int32)))], names=["word", "codes"])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, before, after, slot = kept.value
        cells = np.zeros(CLASSES * CLASSES, dtype=np.int64)
        side = 2 * CLASSES * CLASSES

        def out(words: list[bytes], n: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
            ending = slot[[shape(w) - 1 - TOP_WORDS for w in words]]
            chosen = 1 + np.argmax(np.round((total + ending)[:, 1:], 9), axis=1)
            return pa.record_batch([pa.array(words, pa.binary()), pa.array(n, pa.int64()), pa.array(chosen, pa.int64())], names=["word", "n", "class"])

        def count(near: np.ndarray, own: np.ndarray) -> None:
            """Half transitions of occurrences (the codes of both sides) of words of these classes."""
            for code, left in ((near // side, True), (near % side, False)):
                other = code // 2 % CLASSES
                cell = other * CLASSES + own if left else own * CLASSES + other
                cells[:] += np.bincount(cell, 2 - code % 2, len(cells)).astype(np.int64)

        # What is known of the last word: its occurrences, evidence, and numbers of each side's codes.
        held, held_n, held_total, held_near = None, 0, np.zeros(CLASSES), np.zeros((2, 2 * CLASSES), dtype=np.int64)

        def last() -> pa.RecordBatch:
            got = out([held], np.array([held_n]), held_total[None])
            own = got.column(2)[0].as_py()
            for code in range(2 * CLASSES):
                cells[code // 2 * CLASSES + own] += (2 - code % 2) * held_near[0, code]
                cells[own * CLASSES + code // 2] += (2 - code % 2) * held_near[1, code]
            return got

        for b in batches:
            coded = b.column(0).dictionary_encode()  # rows come by word, so places count words
            words, word = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
            if not words:
                continue
            lists = b.column(1)
            word = np.repeat(word, lists.value_lengths().to_numpy())
            near = lists.flatten().to_numpy().astype(np.int64)
            starts = np.searchsorted(word, np.arange(len(words) + 1))
            n = np.diff(starts)
            total = np.add.reduceat(before[near // side // (2 * CLASSES)] + after[near % side // (2 * CLASSES)], starts[:-1], axis=0)
            if held is not None and held != words[0]:
                yield last()
                held = None
            if held is not None:
                n[0] += held_n
                total[0] += held_total
            else:
                held_near = np.zeros_like(held_near)
            if len(words) > 1:
                done = out(words[:-1], n[:-1], total[:-1])
                chosen = done.column(2).to_numpy()
                count(near[: starts[-2]], chosen[word[: starts[-2]]])
                if held is not None:  # its earlier batches
                    for code in range(2 * CLASSES):
                        cells[code // 2 * CLASSES + chosen[0]] += (2 - code % 2) * held_near[0, code]
                        cells[chosen[0] * CLASSES + code // 2] += (2 - code % 2) * held_near[1, code]
                    held_near = np.zeros_like(held_near)
                yield done
            mine = near[starts[-2] :]
            held_near += np.stack([np.bincount(mine // side % (2 * CLASSES), minlength=2 * CLASSES), np.bincount(mine % side % (2 * CLASSES), minlength=2 * CLASSES)])
            held, held_n, held_total = words[-1], int(n[-1]), total[-1]
        if held is not None:
            yield last()
        cell = np.flatnonzero(cells)
        yield pa.record_batch([pa.nulls(len(cell), pa.binary()), pa.array(cells[cell]), pa.array(cell)], names=["word", "n", "class"])

    sent = encoded.select("seq", "tail").mapInArrow(send, "word binary, codes array<int>")
    return sent.repartition("word").sortWithinPartitions("word").mapInArrow(choose, "word binary, n long, class long")


def with_classes(rows: DataFrame, rare: DataFrame) -> DataFrame:
    """rows without tail, but with its known words' places and classes
    (``known``), n_tail occurrences of them, and tail_log, the sum of
    log10(count + 0.5) over all its words."""
    n, tf = F.coalesce("n", F.lit(0)), F.size("at")
    found = rows.select("uid", F.inline("tail")).join(rare, "word", "left").groupBy("uid").agg(
        F.collect_list(F.when(n > 0, F.struct("at", F.col("class").cast("int").alias("class")))).alias("known"),
        F.sum(F.when(n > 0, tf).otherwise(0)).alias("n_tail"),
        F.sum(tf * F.log10(n + 0.5)).alias("tail_log"),
    )
    return rows.drop("tail").join(found, "uid", "left")


def put_classes(seq: np.ndarray, starts: np.ndarray, known: pa.Array) -> np.ndarray:
    """seq with the classes of the known words of a batch at their places."""
    n_words = known.value_lengths().fill_null(0).to_numpy()
    items = known.flatten()
    places = items.field(0)
    n = places.value_lengths().to_numpy()
    row = np.repeat(np.repeat(np.arange(len(known)), n_words), n)
    seq[starts[row] + places.flatten().to_numpy()] = np.repeat(items.field(1).to_numpy(), n)
    return seq


def fit(df: DataFrame, text: str = "text") -> tuple[dict, DataFrame]:
    """The model (of bounded size), and (word, n, class) of all words that are
    not in it."""
    texts = df.select(text)
    vocabulary = stored(count_words(texts), "lm-vocabulary")
    n_tokens, n_types = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    ends = vocabulary.filter(F.col("word") == END).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    words, counts = head_words(vocabulary)
    n_head = len(words)
    encoded = stored(encode(texts, words, np.arange(n_head + SYMBOLS, dtype=np.int32), text), "lm-encoded", compression="zstd")
    # Symbols, and then classes, of all values in encoded sequences; the last is an end.
    symbol = np.concatenate([[i + 1 if i < TOP_WORDS else shape(w) for i, w in enumerate(words)], np.arange(SYMBOLS), [0]]).astype(np.int64)
    symbols = df.sparkSession.sparkContext.broadcast(symbol)

    def symbol_sequences(batches):
        for b in batches:
            yield symbols.value[joined_texts(b.column(0), np.int32, len(symbols.value) - 1)[0]]

    pairs = bigrams(encoded.select("seq"), symbol_sequences, SYMBOLS)
    mine = exchange(pairs, CLASSES, SWEEPS)
    one = np.zeros((SYMBOLS, CLASSES))
    one[np.arange(SYMBOLS), mine] = 1
    grid = one.T @ pairs @ one
    seed = mine[symbol]
    says = np.array([ending_evidence(grid, c) for c in range(CLASSES)])
    chosen = frequent_classes(encoded, n_head, seed, grid, says[seed[:n_head]])
    class_of = seed.copy()
    class_of[TOP_WORDS:n_head] = chosen[TOP_WORDS:]
    chosen = stored(rare_classes(encoded, n_head, seed, class_of, grid, says[mine[1 + TOP_WORDS :]]), "lm-rare-words")
    rare = chosen.filter(F.col("word").isNotNull())
    classes = df.sparkSession.sparkContext.broadcast(class_of)

    def frequent_sequences(batches):
        final = classes.value.copy()
        final[n_head:-1] = CLASSES  # any other word
        for b in batches:
            yield final[joined_texts(b.column(0), np.int32, len(final) - 1)[0]]

    grid = bigrams(encoded.select("seq"), frequent_sequences, CLASSES + 1)[:CLASSES, :CLASSES].astype(float)
    for cell, n in chosen.filter(F.col("word").isNull()).groupBy("class").agg(F.sum("n")).collect():  # at most one row a cell
        grid[cell // CLASSES, cell % CLASSES] += n / 2
    tokens_of, types_of = np.zeros(CLASSES), np.zeros(CLASSES)
    tokens_of[0], types_of[0] = ends, float(ends > 0)
    tokens_of += np.bincount(class_of[:n_head], counts, CLASSES)
    types_of += np.bincount(class_of[:n_head], minlength=CLASSES)
    for c, n, v in rare.groupBy("class").agg(F.sum("n"), F.count("*")).collect():
        tokens_of[c] += n
        types_of[c] += v
    open_class = np.bincount(mine[1 + TOP_WORDS :], minlength=CLASSES) > 0  # holds unknown words
    model = {
        "words": words, "counts": counts, "class_of": class_of, "seed": seed, "seed_pairs": one.T @ pairs @ one, "transition": transitions(grid),
        "emission": np.log10(np.maximum(tokens_of + 0.5 * (types_of + open_class), 0.5)),
        "train_tokens": int(n_tokens), "train_types": int(n_types), "ends": int(ends),
    }
    return model, rare


def score(df: DataFrame, model: dict, rare: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """n_tokens, n_known, train_tokens, base_score, score of every row."""
    values = model["class_of"][:-1].astype(np.uint8)
    rows = stored(encode(df, model["words"], values, text, id_column, model["counts"], model["ends"]), "lm-rows", compression="zstd")
    kept = df.sparkSession.sparkContext.broadcast((model["transition"], model["emission"]))
    whole = with_classes(rows, rare).select(
        "seq", "known", F.col("id").alias("id"), "n_tokens", (F.col("n_head") + F.coalesce("n_tail", F.lit(0))).alias("n_known"),
        (F.col("head") + F.coalesce("tail_log", F.lit(0.0))).alias("counted"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transition, emission = kept.value
        for b in batches:
            if not b.num_rows:
                continue
            seq, starts = joined_texts(b.column(0), np.uint8, 0)
            seq = put_classes(seq, starts, b.column(1))
            each = transition[seq[:-1], seq[1:]] - emission[seq[1:]]
            part = np.add.reduceat(each, starts - 1)
            yield pa.record_batch([*b.columns[2:], pa.array(part)], names=["id", "n_tokens", "n_known", "counted", "model"])

    scored = whole.mapInArrow(run, f"id {dict(df.dtypes)[id_column]}, n_tokens long, n_known long, counted double, model double")
    base = np.log10(model["train_tokens"] + 0.5 * (model["train_types"] + 1))
    return scored.select(
        F.col("id").alias(id_column), "n_tokens", "n_known", F.lit(model["train_tokens"]).cast("long").alias("train_tokens"),
        (F.col("counted") - F.col("n_tokens") * F.lit(float(base))).alias("base_score"),
        (F.col("counted") + F.col("model")).alias("score"),
    )

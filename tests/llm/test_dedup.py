import hashlib
import itertools
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from meterframe.llm import decontam, graph, line_dedup, minhash, repeats

from .fixtures import documents, empty, frame, shingles_of, words_of

ROWS = documents()


def components_of(sets, percent):
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_minhash_equals_brute_force(spark, k, percent):
    sets = {i: shingles_of(t, k) for i, t in ROWS}
    want = components_of(sets, percent)
    got = minhash.link(frame(spark, ROWS), shingle=k, percent=percent).collect()
    assert len(got) == len(ROWS)
    for r in got:
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), want[r.doc_id])
    assert len(set(want.values())) < len(want)


def test_minhash_large_group_of_near_copies(spark):
    """Hubs and the exact join find every component of a large noisy group."""
    rng = np.random.default_rng(5)
    words = np.array([f"w{i}" for i in range(4000)])
    base = rng.choice(words, 90)
    rows = []
    for i in range(160):
        w = base.copy()
        n = int(rng.integers(0, 12))
        w[rng.choice(90, n, replace=False)] = rng.choice(words, n)
        rows.append((i, " ".join(w)))
    sets = {i: shingles_of(t, 3) for i, t in rows}
    want = components_of(sets, 85)
    got = {r.doc_id: r.component_id for r in minhash.link(frame(spark, rows), shingle=3, percent=85).collect()}
    assert got == want


def test_minhash_prefix_join_is_exact(spark):
    rng = np.random.default_rng(6)
    words = np.array([f"w{i}" for i in range(300)])
    base = rng.choice(words, 60)
    rows = []
    for i in range(60):
        w = base.copy()
        n = int(rng.integers(0, 6))
        w[rng.choice(60, n, replace=False)] = rng.choice(words, n)
        rows.append((i, i, " ".join(w[: int(rng.integers(50, 61))])))
    df = spark.createDataFrame(rows, "uid long, root long, text string")
    found = {(r.a, r.b) for r in minhash.prefix_pairs(df, 3, 85).collect()}
    sets = {i: shingles_of(t, 3) for i, _, t in rows}
    links = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) and sets[a] != sets[b]}
    assert links and links <= found


def test_minhash_empty(spark):
    assert minhash.link(empty(spark)).collect() == []


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    got = {r.id: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(50)}}


def test_components_stop_when_they_are_stars(spark, monkeypatch):
    """A star is recognised as such: no further round is run to see that nothing changes."""
    written = []
    keep = graph.stored
    monkeypatch.setattr(graph, "stored", lambda df, name: written.append(name) or keep(df, name))
    edges = [(1, 1 + i) for i in range(1, 30)] + [(100, 101)]
    got = {r.id: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 31)}, 100: 100, 101: 100}
    assert len(written) == 2  # the links themselves and one round


def test_minhash_few_open_pairs_are_confirmed_at_once(spark, monkeypatch):
    """Few open pairs are confirmed at once, with the components of several rounds."""
    rng = np.random.default_rng(5)
    words = np.array([f"w{i}" for i in range(4000)])
    base = rng.choice(words, 90)
    rows = []
    for i in range(60):
        w = base.copy()
        n = int(rng.integers(0, 12))
        w[rng.choice(90, n, replace=False)] = rng.choice(words, n)
        rows.append((i, " ".join(w)))
    want = components_of({i: shingles_of(t, 3) for i, t in rows}, 85)

    def all_pairs(texts, shingle, percent):
        x, y = (texts.select(F.col("uid").alias(c), F.col("root").alias(f"r{c}")) for c in "ab")
        return x.crossJoin(y).filter("a < b and ra != rb").select("a", "b", F.lit(1).alias("shared"))

    monkeypatch.setattr(minhash, "prefix_pairs", all_pairs)  # so that pairs are open for certain
    calls = []
    keep = minhash.components
    monkeypatch.setattr(minhash, "components", lambda links: calls.append(1) or keep(links))
    run = lambda: {r.doc_id: r.component_id for r in minhash.link(frame(spark, rows), shingle=3, percent=85).collect()}
    assert run() == want
    assert len(calls) == minhash.HUB_ROUNDS + 1
    monkeypatch.setattr(minhash, "FEW_PAIRS", 0)  # rounds, where pairs are many
    monkeypatch.setattr(minhash, "PICK_ROUNDS", 1)
    assert run() == want


def line_truth(rows, percent):
    """Kept texts, removed counts and link counts by brute force."""
    docs = sorted({r for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    lines = [(i, t, line, frozenset(words_of(line))) for i, t in docs if t is not None for line in t.split("\n")]
    first = {}
    for at, (_, _, _, s) in enumerate(lines):
        if s:
            first.setdefault(s, at)
    links = {a: [b for b in first if a != b and 100 * len(a & b) >= percent * len(a | b)] for a in first}
    out = {}
    for at, (i, t, line, s) in enumerate(lines):
        kept, removed, pairs = out.setdefault((i, t), ([], [0], set()))
        pairs.update((s, o) for o in links.get(s, ()))
        if s and (first[s] != at or any(first[o] < at for o in links[s])):
            removed[0] += 1
        else:
            kept.append(line)
    return {key: ("\n".join(kept), removed[0], len(pairs)) for key, (kept, removed, pairs) in out.items()}


@pytest.mark.parametrize("percent", [80, 60])
def test_line_dedup_equals_brute_force(spark, percent):
    want = line_truth(ROWS, percent)
    assert any(v[2] for v in want.values())
    df = frame(spark, ROWS)
    got = line_dedup.dedup(df, percent)
    assert got.columns == [*df.columns, "n_lines", "n_removed"]
    originals = {}
    for i, t in ROWS:
        originals.setdefault(i, t)
    rows = got.collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        t = originals[r.doc_id]
        if t is None:
            assert (r.text, r.n_lines, r.n_removed) == (None, 0, 0)
        else:
            assert (r.text, r.n_removed) == want[r.doc_id, t][:2]
            assert r.n_lines == t.count("\n") + 1
        assert r["kept"] == "kept" and r["_k"] == "_k"


def test_line_dedup_second_round(spark):
    """The nearest earlier line that passes the filters need not be similar:
    every one is tried before a line stays."""
    rng = np.random.default_rng(3)
    rows = []
    words = [f"w{i}" for i in range(40)]
    for i in range(120):
        w = [words[j] for j in rng.choice(40, 20, replace=False)] if i % 3 else words[:20]
        if i % 3 == 0:
            w = w[:]
            w[int(rng.integers(20))] = f"x{i}"
        rows.append((i, " ".join(w)))
    want = line_truth(rows, 60)
    for r in line_dedup.dedup(frame(spark, rows), 60).collect():
        assert (r.text, r.n_removed) == want[r.doc_id, dict(rows)[r.doc_id]][:2]


def test_line_dedup_of_hot_words(spark, monkeypatch):
    """A third of the lines from one template below the threshold, and another
    third similar: long lists by kinds, longer ones block against block."""
    for name, value in {"LONG": 8, "HOT": 20, "BLOCK": 6, "WALK": 50}.items():
        monkeypatch.setattr(line_dedup, name, value)
    rng = np.random.default_rng(5)
    often = [f"often{i}" for i in range(12)]
    template, alike = [f"t{i}" for i in range(17)], [f"s{i}" for i in range(16)]
    rows = []
    for i in range(120):
        own = [template + [f"x{i}a", f"x{i}b", f"x{i}c"], alike + [str(w) for w in rng.choice(often, 4 + i % 2, replace=False)], [str(w) for w in rng.choice(often, 6, replace=False)]]
        rows.append((i, " ".join(own[i % 3])))
    for percent in (80, 60):
        want = line_truth(rows, percent)
        for r in line_dedup.dedup(frame(spark, rows), percent).collect():
            assert (r.text, r.n_removed) == want[r.doc_id, dict(rows)[r.doc_id]][:2]


def entries_of_template(n):
    """Packed entries of n lines that share 17 words and have 3 of their own."""
    columns = {c: np.zeros(n, dtype=t) for c, t in line_dedup.ENTRY}
    rng = np.random.default_rng(n)
    for c in ("b1", "b2"):
        columns[c] = rng.integers(0, 1 << 62, n).astype(np.uint64)
    columns |= {"id": np.arange(n), "n": np.full(n, 20), "place": np.full(n, 3), "probe": np.ones(n)}
    return line_dedup.pack(columns, np.zeros(n, dtype=np.int64))


def test_template_below_the_threshold_is_not_paired():
    """Its lines match too late in their prefixes: no pairs, no cells."""
    out = list(line_dedup._meet(80, False)(iter([entries_of_template(200_000)])))
    assert sum(b.num_rows for b in out) == 0


def test_line_dedup_empty(spark):
    assert line_dedup.dedup(empty(spark)).collect() == []


def repeat_truth(rows):
    seen = Counter()
    raw = [(i, (t or "").encode()) for i, t in rows]
    for _, b in raw:
        seen.update(b[j : j + 200] for j in range(len(b) - 199))
    out = {}
    for i, b in raw:
        gone = np.zeros(len(b), dtype=bool)
        for j in range(len(b) - 199):
            if seen[b[j : j + 200]] > 1:
                gone[j : j + 200] = True
        spans = int((np.diff(np.concatenate([[0], gone, [0]]).astype(int)) == 1).sum())
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[i] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_repeats_equal_brute_force(spark, monkeypatch):
    rows = [(i, t if t is None or len(t) < 20_000 else t[:20_000]) for i, t in ROWS]
    want = repeat_truth(rows)
    got = repeats.digest(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id]
    assert sum(w[1] > 0 for w in want.values()) > 10 and any(0 < w[1] < w[0] for w in want.values())


def test_repeats_partial_overlaps(spark):
    """Passages cut at every length around the threshold, within and across documents."""
    rng = np.random.default_rng(2)
    letters = lambda n: "".join(rng.choice(list("abcdefgh "), n))
    passage = letters(420)
    rows = []
    for i in range(40):
        a = int(rng.integers(0, 230))
        b = a + int(rng.choice([150, 199, 200, 201, 230, 300]))
        rows.append((i, letters(int(rng.integers(0, 300))) + passage[a:b] + letters(int(rng.integers(0, 300)))))
    rows.append((99, passage[:210] + passage[:210] + "z" * 260))
    want = repeat_truth(rows)
    for r in repeats.digest(frame(spark, rows)).collect():
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], r.doc_id


def test_repeats_parts_of_a_long_document():
    data = np.frombuffer(np.random.default_rng(1).bytes(5000), dtype=np.uint8)
    old = repeats.PART
    repeats.PART = 1000
    try:
        offsets = np.array([0, 4500, 5000])
        seen = []
        for lo, hi, a, z in repeats.parts(offsets):
            r = repeats.Runs(offsets, data, lo, hi, a, z)
            for f, last, d in zip(r.first, r.last, r.doc, strict=True):
                seen += [(int(d), int(s) + a) for s in range(f, last + 1)]
        assert sorted(seen) == [(0, i) for i in range(4301)] + [(1, i) for i in range(4500, 4801)]
    finally:
        repeats.PART = old


def test_repeats_empty(spark):
    assert repeats.digest(empty(spark)).collect() == []


def test_decontamination(spark):
    items = [(1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"), (2, "short item"), (3, None), (4, " \n "), (5, "short item")]
    text = items[0][1]
    almost = text.replace("twenty", "thirty")  # 15 of 17 shingles
    docs = [
        (1, f"Intro words. {text.upper()}\nand more"), (2, almost + " end"), (3, "clean text about nothing at all"), (4, None), (5, ""),
        (6, "a very\tSHORT\n item here"), (7, " ".join(text.split()[:10])), (8, text), (8, text), (9, "x " * 30_000 + text),
    ]
    got = {(r.id, r.item): r.similarity for r in decontam.matches(frame(spark, docs), frame(spark, items, "item_id")).collect()}
    assert set(got) == {(1, 1), (2, 1), (8, 1), (9, 1), (6, 2), (6, 5)}
    assert got[1, 1] == got[8, 1] == 1.0 and 0.8 <= got[2, 1] < 1
    left = decontam.clean(frame(spark, docs), frame(spark, items, "item_id"))
    assert sorted(r.doc_id for r in left.collect()) == [3, 4, 5, 7]
    assert decontam.matches(empty(spark), frame(spark, items, "item_id")).collect() == []
    assert decontam.matches(frame(spark, docs), empty(spark, "item_id")).collect() == []


def window_truth(docs, items, threshold=0.8):
    """Best similarity over all windows of each document for each item."""
    best = {}
    for (i, text), (j, item) in itertools.product(docs, items):
        w, v = text.split(), item.split()
        n, k = len(v), min(len(v), 5)
        bag = lambda x: Counter(" ".join(x[p : p + k]) for p in range(max(len(x) - k + 1, 1)))  # noqa: B023,E731
        mass = lambda b: sum(math.log1p(len(s)) * c for s, c in b.items())
        own = bag(v)
        for at in range(max(len(w) - n, 0) + 1):
            b = bag(w[at : at + n])
            both = mass(b & own)
            similarity = both / (mass(b) + mass(own) - both)
            if similarity >= threshold - 1e-12:
                best[i, j] = max(best.get((i, j), 0), round(similarity, 9))
    return best


def test_decontamination_items_with_repeated_words(spark):
    """A run of one word at the end does not hide what an item and a window share."""
    rng = random.Random(7)
    items, docs = [], []
    for i, (n, run) in enumerate([(200, 20)] * 8 + [(150, 16)] * 8):
        body = [f"{rng.choice('abcdefgh')}{rng.randrange(10**6)}" for _ in range(n - run)]
        items.append((i, " ".join(body + ["0"] * run)))
        docs.append((i, " ".join(body + ["total"] * run)))
    want = window_truth(docs, items)
    got = {(r.id, r.item): r.similarity for r in decontam.matches(frame(spark, docs), frame(spark, items, "item_id")).collect()}
    assert set(want) == {(i, i) for i in range(16)}
    assert got == pytest.approx(want, abs=2e-9)


def test_decontamination_takes_every_window(spark):
    """Words inserted in a passage: the best window may line up with no shingle."""
    rng = random.Random(11)
    word = lambda: f"{rng.choice('abcdefgh')}{rng.randrange(10**6)}"
    items, docs = [], []
    for i in range(120):
        n = rng.randint(60, 150)
        v = [word() for _ in range(n)]
        at, more = rng.randrange(10, n - 10), max(1, round(n * rng.choice([0.06, 0.07, 0.08, 0.09])))
        items.append((i, " ".join(v)))
        docs.append((i, " ".join([word() for _ in range(8)] + v[:at] + [word() for _ in range(more)] + v[at:] + [word() for _ in range(8)])))
    items += [(500, "0 " * 30 + "end"), (501, "a b a b a b c")]
    docs += [(500, "0 " * 70), (501, "x a b a b a b a b a b c y"), (502, "a b a b a b c"), (503, "0 " * 28)]
    want = {k: v for i in range(0, 124, 4) for k, v in window_truth(docs[i : i + 4], items[i : i + 4] + items[120:]).items()}
    got = {(r.id, r.item): r.similarity for r in decontam.matches(frame(spark, docs), frame(spark, items, "item_id")).collect()}
    assert 20 < len(want) < 120
    assert got == pytest.approx(want, abs=2e-9)


def test_decontamination_runs_no_python(spark):
    docs, items = frame(spark, [(1, "a b c d e f g")]), frame(spark, [(1, "a b c d e f")], "item_id")
    plan = decontam.matches(docs, items)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "InPandas", "InArrow"))


@pytest.mark.parametrize("far", [False, True])
def test_line_dedup_order_of_entries(far):
    """Entries go by word, id, line and kk, whether or not the ids fit 32 bits."""
    r = np.random.default_rng(5)
    e = {"word": r.integers(0, 9, 4000).astype("u4"), "id": r.integers(-7, 7, 4000), "line": r.integers(0, 4, 4000).astype("u4"), "kk": r.integers(0, 3, 4000).astype("u4")}
    e["word"][:5] = 0xFFFFFFFF
    if far:
        e["id"][7], e["id"][8] = line_dedup.LEAST_ID, (1 << 63) - 1
    sort = [e[c][line_dedup.by_word(e)].tolist() for c in ("word", "id", "line", "kk")]
    assert list(zip(*sort, strict=True)) == sorted(zip(*(e[c].tolist() for c in ("word", "id", "line", "kk")), strict=True))
    assert len(line_dedup.by_word({c: v[:0] for c, v in e.items()})) == 0


def test_line_dedup_partial_counts_are_added_as_they_come():
    """One sum a slice, whatever number of batches and slices a task reads."""
    one = lambda i, n: (i, np.full(line_dedup.SLICE, n, dtype=np.uint32).tobytes())
    batch = lambda *rows: pa.record_batch([pa.array([i for i, _ in rows], pa.int32()), pa.array([c for _, c in rows], pa.binary())], names=["slice", "counts"])
    got = [r for b in line_dedup._add_up(iter([batch(one(3, 2), one(1, 5)), batch(one(3, 4)), batch(one(1, 0xFFFFFFFF))])) for r in b.to_pylist()]
    assert {r["slice"]: set(np.frombuffer(r["counts"], dtype=np.uint32).tolist()) for r in got} == {3: {6}, 1: {0xFFFFFFFF}}
    assert len(got) == 2


@pytest.mark.parametrize("size", [1, 2, 3, 40])
def test_line_dedup_walk_of_short_lists(size):
    """A list shorter than CLEAR steps is met whole and nothing before it is."""
    columns = {c: np.ones(2 * size, dtype=t) for c, t in line_dedup.ENTRY}
    columns |= {"word": np.repeat([4, 5], size), "id": np.arange(2 * size), "n": np.full(2 * size, 10), "b1": np.zeros(2 * size), "b2": np.zeros(2 * size), "p1": np.zeros(2 * size), "p2": np.zeros(2 * size), "place": np.zeros(2 * size)}
    packed = line_dedup.pack(columns, np.zeros(2 * size, dtype=np.int64))
    for every, pairs in ((True, {(i, j) for i in range(size) for j in range(i)}), (False, {(i, i - 1) for i in range(1, size)})):
        got = [r for b in line_dedup._meet(80, every)(iter([packed])) for r in b.to_pylist() if r["entries"] is None]
        assert sorted((r["id"], r["id_2"]) for r in got) == sorted(pairs | {(i + size, j + size) for i, j in pairs})

"""SimHash near-dedup, source divergence and hard negatives against brute force."""

import random
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from check_oracle import rows_of
from meterframe.llm import divergence, negatives, registry, simhash

from . import fixtures as X


# ------------------------------------------------------------------ SimHash
def print_of(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words)] if len(words) < 3 else [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots_of(prints, radius=2):
    """The smallest fingerprint of each one's component."""
    prints = sorted(set(prints))
    up = {p: p for p in prints}

    def top(p):
        while up[p] != p:
            p = up[p]
        return p

    for i, p in enumerate(prints):
        for q in prints[:i]:
            if (p ^ q).bit_count() <= radius:
                a, b = sorted((top(p), top(q)))
                up[b] = a
    return {p: top(p) for p in prints}


def near_copies(rng, n, edits):
    words = X.vocabulary(rng)
    base = rng.choices(words, k=900)
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = rng.choice(words)
        out.append(" ".join(w))
    return out


def simhash_rows():
    rows = X.documents()
    texts = near_copies(random.Random(5), 25, 6)
    rows += [(1000 + i, t) for i, t in enumerate(texts)]
    return [*rows, (None, "two words"), (None, "no one else has this"), (-3, texts[4]), (3, "an id with another text")]


@pytest.mark.parametrize("limit", [simhash.BUCKET_LIMIT, 2])
def test_simhash_components(spark, limit):
    rows = simhash_rows()
    got = simhash.link(X.frame(spark, rows), bucket_limit=limit).collect()
    prints = [print_of(t) for _, t in rows]
    root = roots_of(prints)
    least = {}
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    want = Counter((i, p, least.get(root[p])) for (i, _), p in zip(rows, prints, strict=True))
    assert Counter((r[0], r[1] & (1 << 64) - 1, r[2]) for r in got) == want
    assert len({v for v in least.values()}) < len(rows) - 20  # near copies were linked, beside equal texts


def test_simhash_of_an_empty_table(spark):
    assert simhash.link(X.empty(spark)).collect() == []


@pytest.mark.parametrize("limit", [1 << 30, 8, 1])
@pytest.mark.parametrize("radius", [1, 2])
def test_links_tie_all_components(spark, limit, radius):
    """Groups of thousands of pairs, chains, far ones and bit 63, on both ways."""
    rng = random.Random(7)
    prints = {0, 1 << 63, (1 << 64) - 1, 3 << 62}
    for _ in range(3):  # dense groups: few bits vary
        c, bits = rng.getrandbits(64), rng.sample(range(64), 7)
        prints |= {c ^ sum(1 << b for b in bits if rng.random() < 0.4) for _ in range(60)}
    for _ in range(20):  # chains
        c = rng.getrandbits(64)
        for _ in range(6):
            c ^= sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3])))
            prints.add(c)
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    rows = [(signed(p),) for p in prints]
    found = simhash.links(spark.createDataFrame(rows, "print long"), radius, limit).collect()
    pairs = {(a & (1 << 64) - 1, b & (1 << 64) - 1) for a, b in found}
    assert all(0 < (a ^ b).bit_count() <= radius for a, b in pairs)
    want = roots_of(prints, radius)
    up = {p: p for p in prints}

    def top(p):
        while up[p] != p:
            p = up[p]
        return p

    for a, b in pairs:
        x, y = sorted((top(a), top(b)))
        up[y] = x
    assert {p: top(p) for p in prints} == want
    if limit > 1 << 20:  # the paired way finds every link, once
        assert len(found) == sum((a ^ b).bit_count() <= radius for a in prints for b in prints if a < b)


def test_a_large_group_does_not_make_all_pairs(spark):
    rng = random.Random(9)
    bits = rng.sample(range(64), 11)
    prints = [(sum(1 << b for i, b in enumerate(bits[:-1]) if n >> i & 1),) for n in range(1 << 10)]
    signed = [(p - (1 << 64) if p >> 63 else p,) for (p,) in prints]
    found = simhash.links(spark.createDataFrame(signed, "print long"))
    assert found.count() <= 65 * len(prints)  # of 56,320 pairs that are close


def test_xxh64_equals_the_library():
    import numpy as np

    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 3000, dtype=np.uint8)
    start = rng.integers(0, 2700, 500)
    end = start + rng.integers(0, 300, 500)
    got = simhash.xxh64(data, start, end)
    assert [int(h) for h in got] == [xxhash.xxh64_intdigest(data[s:e].tobytes(), 42) for s, e in zip(start, end, strict=True)]


# --------------------------------------------------------------- divergence
def source_rows(seed=11, n=400):
    """lang, source and text, with nulls, copies, empty and odd texts; a hot copy."""
    rng = random.Random(seed)
    words = X.vocabulary(rng, 60) + ["naïve", "ÀB", "日本語", "x1y2", "don't", "A_B"]
    copies = [" ".join(rng.choices(words, k=30)) for _ in range(6)]
    rows = []
    for _ in range(n):
        lang, source = rng.choice(["en", "en", "de", None, "xx"]), rng.choice(["a", "b", "c", "é", None, "hot", "hot"])
        own = words[: 40 if source in ("a", "hot") else 66]
        text = rng.choice([None, "", "  1 2 ", *copies, *copies[:1] * 5, *(" ".join(rng.choices(own, k=rng.randint(1, 60))) for _ in range(8))])
        rows.append((lang, source, text))
    return rows + [("lonely", "only", "one source here")] + [("lonely2", s, "rare") for s in "pq"] + [rows[0]] * 3


def audit_of(rows, least=30, top=50):
    docs, groups, total = Counter(), defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        raw = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in (text or "").encode())
        words = [w.decode() for w in raw.split()]
        groups[lang, source].update(words)
        total[lang].update(words)
        docs.update((lang, w) for w in set(words))
    out = []
    for lang in total:
        kept = sorted(w for (la, w), n in docs.items() if la == lang and n >= least)

        def shares(c, kept=kept):
            n = sum(c[w] for w in kept)
            return {w: 1 + 10**9 * (c[w] + 5) // (n + 5 * len(kept)) for w in kept}

        q = shares(total[lang])
        own = {s: shares(c) for (la, s), c in groups.items() if la == lang}
        for s, p in own.items():
            pair = [(sum(abs(p[w] - o[w]) for w in kept), t) for t, o in own.items() if t != s]
            term = [(p[w] - q[w], w) for w in kept if groups[lang, s][w] and p[w] > q[w]]
            for part, items, most in (("pair", pair, len(pair)), ("term", term, top)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return Counter(out)


@pytest.mark.parametrize("top", [50, 3])
def test_divergence(spark, top):
    rows = source_rows()
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], "lang string, source string, text string, term string, k string, n int")
    got = Counter(tuple(r) for r in divergence.audit(df, top=top).collect())
    want = audit_of(rows, top=top)
    assert got == want and sum(r[2] == "term" for r in want) > 20


def test_divergence_counts_every_repeat(spark):
    """One text that is most of a language, over several tasks and sources."""
    rows = [("en", f"s{i % 3}", "alpha beta alpha") for i in range(90)] + [("en", "s0", f"beta gamma {i}") for i in range(40)]
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(7)
    assert Counter(tuple(r) for r in divergence.audit(df).collect()) == audit_of(rows)


def test_a_full_bitmap_changes_nothing(spark, monkeypatch):
    """Texts that the bitmap mistakes for repeated ones take the longer way."""
    rows = source_rows(3, 150)
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    monkeypatch.setattr(divergence, "key_filter", lambda keys: b"\xff" * (1 << 21))
    assert Counter(tuple(r) for r in divergence.audit(df, least_docs=5).collect()) == audit_of(rows, 5)


def test_divergence_of_little(spark):
    kind = "lang string, source string, text string"
    assert divergence.audit(spark.createDataFrame([], kind)).collect() == []
    got = divergence.audit(spark.createDataFrame([("l", "a", None), ("l", "b", "word")], kind)).collect()
    assert {tuple(r) for r in got} == {("l", "a", "pair", "b", 0, 1), ("l", "b", "pair", "a", 0, 1)}


def test_a_long_text_is_cut_in_pieces(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 10)
    text = ("Ab cd-ef " * 50 + "x" * 300).encode()
    assert divergence.term_counts(text) == Counter({b"ab": 50, b"cd": 50, b"ef": 50, b"x" * 300: 1})


# ---------------------------------------------------------- hard negatives
NAN, INF = float("nan"), float("inf")


def vector_rows(seed=2, n=700, dim=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        v = [rng.choice([-0.5, 0.0, 0.25, 0.5, rng.uniform(-1, 1)]) for _ in range(dim)]  # many equal scores
        rows.append((i, v, rng.randrange(10)))
    rows[7:12] = [(7, None, 1), (8, [NAN] * dim, 1), (9, [INF, 0.0, 0.0, 0.0], 2), (10, [None, 0.1, 0.1, 0.1], 3), (11, rows[11][1], None)]
    rows[200] = (200, [0.0] * dim, 4)
    rows[300] = (300, None, 4)
    rows += [rows[100], rows[5], (None, [0.1] * dim, 1), (1400, [0.5], 1), (1401, [0.25], 1), (1402, [0.2], 2), (1403, [0.3], 1), (2100, [], 0), (2101, [], 1), (2800, [-0.5] * dim, 3)]
    return rows


def mined(rows, positives=5, negatives_=10):
    import math

    good = {}
    for i, v, label in rows:
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v):
            good[i] = ((label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v])
    out = []
    for a, (label, v) in good.items():
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i, lb) for i, (lb, w) in good.items() if i != a and len(w) == len(v))
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            fits = [(n, i) for n, i, lb in scored if lb != label and 30 * -s <= 100 * -n <= 90 * -s][:negatives_]
            out += [(a, p, r + 1, i, -s, -n) for r, (n, i) in enumerate(fits)]
    return Counter(out)


def embeddings(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, id string, score int")


def mine(df, **k):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return Counter(tuple(r) for r in negatives.mine(df, F.col("id") % 100 == 0, label=label, **k).collect())


def test_hard_negatives(spark, monkeypatch):
    rows = vector_rows()
    want = mined(rows)
    assert mine(embeddings(spark, rows)) == want and len({k[:2] for k in want}) > 20
    monkeypatch.setattr(negatives, "BLOCK", 60)  # many cells
    monkeypatch.setattr(negatives, "GROUP", 3)
    monkeypatch.setattr(negatives, "CHUNK", 2)
    assert mine(embeddings(spark, rows)) == want
    assert mine(embeddings(spark, rows), positives=40, negatives=3) == mined(rows, 40, 3)


def test_hard_negatives_of_one_hot_label_and_vector(spark):
    """A third of the rows are one vector of one label."""
    rng = random.Random(4)
    rows = [(i, [0.3, 0.2] if i % 3 == 0 else [rng.uniform(0, 0.4), rng.uniform(0, 0.4)], 1 if i % 3 == 0 else rng.randrange(10)) for i in range(900)]
    assert mine(embeddings(spark, rows)) == mined(rows)


def test_scores_are_exact_or_an_error():
    import numpy as np

    x = np.array([[1 << 30, 3], [5, -(1 << 30)]])
    assert negatives.scores(x, x).tolist() == [[(1 << 60) + 9, 5 * (1 << 30) - 3 * (1 << 30)], [2 << 30, 25 + (1 << 60)]]
    with pytest.raises(ArithmeticError):
        negatives.scores(x << 10, x)


def test_no_rows_no_negatives(spark):
    assert mine(embeddings(spark, [])) == Counter()
    assert mine(embeddings(spark, [(100, [0.5], 1)])) == Counter()


# ------------------------------------------- registered queries on a folder
@pytest.mark.parametrize("name", ["op12_source_divergence", "op13_hard_negatives"])
def test_query_equals_its_sql(spark, tmp_path, name):
    import duckdb

    docs = spark.createDataFrame([(i, r[2], r[0], r[1]) for i, r in enumerate(source_rows())], "doc_id long, text string, lang string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    embeddings(spark, vector_rows()).select("vec_id", F.col("embedding").cast("array<float>").alias("embedding"), "label").write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    want = con.execute(registry.ORACLE[name])
    columns = [d[0] for d in want.description]
    got = registry.QUERIES[name](spark, str(tmp_path))
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(columns, want.fetchall())


def test_op11_query(spark, tmp_path):
    rows = simhash_rows()
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.QUERIES["op11_deletion_variants"](spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.fingerprint) for r in got) == Counter((i, f"{print_of(t):016x}") for i, t in rows)

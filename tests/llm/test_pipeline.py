"""Every stage of corpus_pipeline.py against brute force, on rows that repeat
ids and texts, have no id, or have no text."""

import random
from collections import Counter

import pytest

import corpus_pipeline as P
from meterframe.llm import quality, registry

from . import fixtures as X
from .test_dedup import line_truth, window_truth

KIND = "doc_id long, text string, lang string, source string, n_chars long"
ITEM = " ".join(f"item{i}" for i in range(40))


def rows_of(docs):
    return [(i, t, "en", "s", None if t is None else len(t)) for i, t in docs]


def stage(spark, name, docs, sf_dir="/nowhere"):
    out = dict(P.STAGES)[name](spark, spark.createDataFrame(rows_of(docs), KIND), str(sf_dir))
    assert out.columns[:5] == list(P.COLUMNS)
    return [tuple(r) for r in out.collect()]


def similar(a, b):
    a, b = X.shingles_of(a, 5), X.shingles_of(b, 5)
    return bool(a) and bool(b) and 100 * len(a & b) >= 80 * len(a | b)


def duplicates_truth(docs):
    """The first document, by id and text hash order, of each group."""
    nodes = list(dict.fromkeys(docs))
    group = list(range(len(nodes)))
    for i in range(len(nodes)):
        for j in range(i):
            if similar(nodes[i][1], nodes[j][1]) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return [[nodes[i] for i in range(len(nodes)) if group[i] == g] for g in sorted(set(group))]


def nasty(seed=1):
    rng = random.Random(seed)
    words = X.vocabulary(rng)
    say = lambda n: " ".join(rng.choices(words, k=n))
    a, b, c = say(50), say(60), say(40)
    near = a.split()
    near[3] = "changed"
    docs = [(3, a), (5, a), (5, b), (None, b), (None, c), (None, " ".join(near)), (7, None), (7, ""), (8, "two words"), (9, "two words"), (9, "two words"), (10, say(3000))]
    docs += [(20 + i, " ".join([*a.split()[:45], *say(i % 6).split()])) for i in range(12)]
    return docs


def test_duplicates(spark):
    docs = nasty()
    got = Counter((r[0], r[1]) for r in stage(spark, "duplicates", docs))
    times = Counter(docs)
    for members in duplicates_truth(docs):
        kept = [m for m in members if m in got]
        least = min(members, key=lambda m: (m[0] is not None, m[0] or 0))[0]
        assert len(kept) == 1 and kept[0][0] == least and got[kept[0]] == times[kept[0]]
    assert (5, docs[0][1]) not in got


def test_duplicates_of_repeated_ids(spark):
    rng = random.Random(2)
    a, b = (" ".join(rng.choices(X.vocabulary(rng), k=30)) for _ in "ab")
    assert sorted((r[0], r[1] == a) for r in stage(spark, "duplicates", [(3, a), (5, a), (5, b)])) == [(3, True), (5, False)]


def test_benchmark(spark, tmp_path):
    spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    leak = f"before {ITEM} after"
    close = ITEM.replace("item39", "other")
    far = " ".join(ITEM.split()[:20])
    docs = [(1, leak), (1, "clean words only"), (None, leak), (None, "clean"), (2, close), (3, far), (4, None), (5, ""), (6, leak), (6, leak), (7, "clean words only")]
    bad = {t for _, t in docs if t and window_truth([(0, t)], [(1, ITEM)])}
    assert bad == {leak, close}
    got = Counter((r[0], r[1]) for r in stage(spark, "benchmark", docs, tmp_path))
    assert got == Counter(d for d in docs if d[1] not in bad)


def test_lines(spark):
    docs = X.documents() + [(3, "an id with another text\nand a line")]
    want = line_truth(docs, 80)
    got = Counter((r[0], r[1]) for r in stage(spark, "lines", docs))
    left = Counter()
    for i, t in docs:
        if t is None:
            left[i, t] += 1
        else:
            kept, removed, _ = want[i, t]
            if not removed or kept.strip(" \t\n\v\f\r"):
                left[i, kept] += 1
    assert got == left


def test_tokens(spark):
    tokenizers = pytest.importorskip("tokenizers")
    codec = tokenizers.Tokenizer.from_file(registry.vocabulary_path())
    codec.no_truncation()
    codec.no_padding()
    docs = nasty()
    for i, text, _, _, _, n, ids in stage(spark, "tokens", docs):
        assert (i, text) in docs and n == len(ids)
        assert ids == codec.encode(text or "", add_special_tokens=False).ids


def test_quality(spark):
    """What the operator scores below the floor goes, and nothing else."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = quality.fit(registry.labelled_documents(spark, sf))
    scores = quality.score(docs, model, {"doc_id": "long"}).collect()
    got = Counter(r.doc_id for r in P.quality_stage(spark, docs, sf).collect())
    assert got == Counter(r.doc_id for r in scores if r.quality_score >= registry.QUALITY_FLOOR)
    empty = P.quality_stage(spark, docs.limit(0), sf)
    assert empty.collect() == [] and empty.columns == list(P.COLUMNS)


@pytest.mark.parametrize("name", ["lines", "duplicates", "tokens"])
def test_stages_of_an_empty_table(spark, name):
    assert stage(spark, name, []) == []


def test_run(spark):
    sf = "/root/testdata/sf0.001"
    out = P.run(spark, sf)
    rows = out.collect()
    assert out.columns == [*P.COLUMNS, "n_tokens", "ids"] and 0 < len(rows) < 200
    assert all(r.n_tokens == len(r.ids) for r in rows)
    texts = [r.text for r in rows]
    assert not any(similar(a, b) for i, a in enumerate(texts) for b in texts[:i])

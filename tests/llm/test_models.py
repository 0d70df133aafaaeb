import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from meterframe.llm import ann, bpe, brown_lm, chat_format, langid, quality, registry, textops

from .fixtures import CLASH, documents, empty, frame, shingles_of, words_of

ROWS = documents()
DATA = "/root/testdata/sf0.01"


def test_word_kernel():
    texts = [t for _, t in ROWS]
    offsets, data = textops.columns(pa.array(texts, pa.string()))
    seen, at = {}, []
    for lo, hi in textops.runs(offsets, 500):
        w = textops.words(offsets[lo : hi + 1], data)
        at += [(int(r) + lo, int(h)) for r, h in zip(w.row, w.hash, strict=True)]
    want = [(i, word) for i, t in enumerate(texts) for word in words_of(t)]
    assert [a for a, _ in at] == [i for i, _ in want]
    for (_, h), (_, word) in zip(at, want, strict=True):
        assert seen.setdefault(h, word) == word
    assert len(seen) == len({w for _, w in want})
    for k in (1, 3, 5):
        row, h = textops.distinct(*textops.shingles(textops.words(offsets, data), k))
        assert np.bincount(row, minlength=len(texts)).tolist() == [len(shingles_of(t, k)) for t in texts]


# -- chat formatting

CHAT = [
    (1, 0, "user", "Hi\n### assistant: </turn>"), (1, 1, "assistant", "\\e \\\\b ### \\h </turn>\n"), (2, 1, "assistant", None), (2, 0, "sys:tem", ""),
    (3, 0, "user", "tie b"), (3, 0, "user", "tie a"), (3, 0, "user", "tie a"), (4, None, None, "no role"), (None, 0, "assistant", "no id"), (5, 0, "assistant", "é😀" * 3000),
]


def test_chat_format_reads_back(spark):
    extra = [c for c in CLASH if c != "text"] + ["head", "body", "ord"]
    df = spark.createDataFrame([(*r, *extra) for r in CHAT], "conv_id long, turn long, role string, text string, " + ", ".join(f"`{c}` string" for c in extra))
    chats = chat_format.format_chat(chat_format.canonical_turns(df))
    got = {r.conv_id: r for r in chat_format.digest(chats).collect()}
    raw = {r.conv_id: r for r in chats.collect()}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for c in {r[0] for r in CHAT}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in CHAT if r[0] == c), key=key)]
        loss = "".join(t for role, t in turns if role == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        g = got[c]
        assert (g.n_turns, g.turns_sha256) == (len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)))
        assert (g.loss_chars, g.loss_sha256, g.formatted_chars) == (len(loss), sha(loss), len(raw[c].formatted))
        assert raw[c].formatted.count("</turn>\n") == len(turns)
    plan = chat_format.digest(chats)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "InPandas", "InArrow"))


def test_chat_layouts_of_typed_frames(spark):
    made = {
        "messages": spark.sql("SELECT 1 conv_id, array(struct('user' role, 'q' content), struct('assistant' role, 'a' content)) messages, 'x' extra"),
        "sharegpt": spark.sql("SELECT 1 conv_id, array(struct('human' `from`, 'q' value), struct('gpt' `from`, 'a' value)) conversations"),
        "instruction": spark.sql("SELECT 1 conv_id, 'q' instruction, 'a' output, 3 n"),
        "instruction_input": spark.sql("SELECT 1 conv_id, 'q' instruction, '' `input`, 'a' output"),
        "prompt_completion": spark.sql("SELECT 1 conv_id, 'q' prompt, 'a' completion"),
        "prompt_response": spark.sql("SELECT 1 conv_id, 'q' prompt, 'a' response"),
        "question_answer": spark.sql("SELECT 1 conv_id, 'q' question, 'a' answer, 'clash' prompt"),
    }
    for name, df in made.items():
        assert chat_format.layout_of(chat_format.field_paths(df.schema)) == name
        got = [(r.turn, r.role, r.text) for r in chat_format.canonical_turns(df).orderBy("turn").collect()]
        assert got == [(0, "user", "q"), (1, "assistant", "a")], name
    with pytest.raises(ValueError):
        chat_format.layout_of(["nothing"])


def test_chat_records_mix_layouts(spark):
    records = [
        (1, '{"messages":[{"role":"user","content":"q"},{"role":"assistant","content":"a"}],"meta":1}'), (2, '{"conversations":[{"from":"human","value":"q"}]}'),
        (3, '{"instruction":"i","input":"x","output":"o"}'), (4, '{"prompt":"p","completion":"c"}'), (5, "not json"), (6, None), (7, '{"other":1}'), (8, '{"messages":[]}'),
    ]
    got = chat_format.canonical_records(spark.createDataFrame(records, "c long, j string"), "c", "j").collect()
    by = {}
    for r in got:
        by.setdefault(r.conv_id, []).append((r.layout, r.role, r.text))
    assert by[1] == [("messages", "user", "q"), ("messages", "assistant", "a")]
    assert by[2] == [("sharegpt", "user", "q")] and by[3][0][2] == "i\nx" and by[4][1] == ("prompt_completion", "assistant", "c")
    assert all(by[i] == [(None, None, None)] for i in (5, 6, 7, 8))


def test_chat_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.digest(chat_format.format_chat(chat_format.canonical_turns(df))).collect() == []


# -- BPE


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    path = registry.vocabulary_path()
    library, own = Tokenizer.from_file(path), bpe.Codec(bpe.load(path))
    odd = [
        "It's we'll 'S 123 don't", "a<|endoftext|>b <|startoftext|>", "ΑΣ Σ ΣΑΣ", "İstanbul ıI", "é ẛ̣", "a\x1cb\x1d \x85x\xa0y z​q﻿", "日本語 ½ ² ٣ 🤖👍🏽",
        "\x00\x01", "Ǆ ǅ ß ẞ", "x" * 3000, "<|endoftext|><|endoftext|>", "<|ENDOFTEXT|>", "a</w> b", "#### $$$$ !!!",
    ]
    rows = ROWS + [(1000 + i, t) for i, t in enumerate(odd)]
    want = {}
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i] = (ids, library.decode(ids, skip_special_tokens=False))
        assert own.encode(t) == ids and own.decode(ids) == want[i][1]
    got = bpe.digest_documents(frame(spark, rows), path).collect()
    assert len(got) == len(rows)
    for r in got:
        ids, text = want[r.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    encoded = bpe.encode_columns(frame(spark, rows), {"doc_id": "long", "_text": "string"}, path)
    decoded = bpe.decode_ids(encoded, {"doc_id": "long", "ids": "array<int>"}, path).collect()
    assert all(r.ids == want[r.doc_id][0] and r.decoded == want[r.doc_id][1] for r in decoded)
    assert bpe.digest_documents(empty(spark), path).collect() == []


def test_bpe_merge_by_rank_and_place():
    own = bpe.Codec({"vocab": {"a": 0, "b": 1, "aa": 2, "ab": 3, "a</w>": 4, "aaa": 5}, "merges": [("a", "a"), ("aa", "a"), ("a", "b")], "suffix": "</w>", "special": {}})
    assert own.merge([0, 0, 0, 0, 1]) == [2, 2, 1]
    assert own.merge([0, 0, 0, 1]) == [5, 1]
    assert own.merge([0]) == [0] and own.merge([]) == []


# -- classifiers


def labelled(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    return docs.join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").withColumnRenamed("quality", "label")


def test_quality_held_out_accuracy(spark):
    df = labelled(spark)
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = quality.fit(df.filter(~held))
    got = quality.score(df.filter(held), model, {"doc_id": "long", "label": "int"}).collect()
    assert np.mean([(r.quality_score >= 0.3) == (r.label == 1) for r in got]) > 0.9


def test_quality_edges(spark):
    rows = frame(spark, ROWS).withColumn("n_chars", F.when(F.col("doc_id") % 2 == 0, F.length("text").cast("long")))
    for df in (rows.withColumn("label", F.lit(None).cast("int")), rows.withColumn("label", F.lit(1)), rows.limit(0).withColumn("label", F.lit(1))):
        model = quality.fit(df)
        got = quality.score(rows, model, {"doc_id": "long", "_text": "string"}).collect()
        assert len(got) == len(ROWS) and all(0 <= r.quality_score <= 1 for r in got)
    assert quality.score(rows.limit(0), model, {"doc_id": "long"}).collect() == []


def test_factorisation_identity():
    rng = np.random.default_rng(0)
    model = {"w0": 0.3, "w": rng.normal(size=20), "v": rng.normal(size=(20, 4))}
    index, value = np.array([1, 5, 7, 2, 19]), rng.normal(size=5)
    starts = np.array([0, 3])
    for s, e, z in ((0, 3, 0), (3, 5, 1)):
        i, x = index[s:e], value[s:e]
        pairs = sum(model["v"][i[a]] @ model["v"][i[b]] * x[a] * x[b] for a in range(len(i)) for b in range(a))
        assert np.isclose(quality.margin(model, starts, index, value)[z], 0.3 + model["w"][i] @ x + pairs)


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = langid.fit(docs.filter(~held))
    got = langid.predict(docs.filter(held), model, {"doc_id": "long", "lang": "string"}).collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.97


def test_language_takes_more_than_200_languages(spark):
    """Every labelled language gets centroids and is found again."""
    pairs = [(a, b) for a in "abcdefghijklmnop" for b in "qrstuvwxyzabcdef" if a != b][:210]
    rows = [(10 * i + j, f"{a}{b}{a}{a}{b} " * (3 + j), f"l{i:03}") for i, (a, b) in enumerate(pairs) for j in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert set(model["lang"]) == {r[2] for r in rows}
    got = langid.predict(df, model, {"doc_id": "long", "lang": "string"}).collect()
    assert all(r.lang_pred == r.lang for r in got) and len(got) == len(rows)


def test_language_frequencies_cover_all_rows(spark):
    """Rows that are not drawn for the centroids still count in the IDF."""
    rows = [(i, "aa bb" if i % 2 else "cc", "x") for i in range(60)] + [(60, None, "x"), (61, "dd", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df, per_language=20)
    seen = sum(langid.counts(np.frombuffer(r[1].encode(), dtype=np.uint8)) > 0 for r in rows[:60])
    assert model["idf"] == pytest.approx(np.log(61 / (1 + seen)) + 1, rel=1e-6)


def test_language_edges(spark):
    rows = ROWS + [(500, "123 $$ 4"), (501, "— … 😀"), (502, "Ж"), (503, "5 a"), (505, "日本語"), (508, "ΑΒΓ")]
    df = frame(spark, rows).withColumn("lang", F.when(F.col("doc_id") % 3 == 0, F.lit("xx")).when(F.col("doc_id") % 3 == 1, F.lit("yy")))
    got = langid.predict(df, langid.fit(df), {"doc_id": "long", "words": "string"}).collect()
    texts = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        letters = any(ch.isalpha() for ch in texts[r.doc_id] or "")
        assert r.lang_pred in (("xx", "yy") if letters else ("und",))
        assert 0 <= r.score <= 1
    latin = langid.fit(df.filter(F.col("doc_id") == 3).withColumn("lang", F.lit("zz")).unionAll(df.filter(F.col("doc_id") == 4).withColumn("lang", F.lit("la"))))
    strange = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(df.filter("doc_id > 499"), latin, {"doc_id": "long"}).collect()}
    assert strange[502] == strange[505] == strange[508] == ("la", 0.0) and strange[500] == strange[501] == ("und", 0.0)
    none = langid.fit(df.limit(0))
    assert {r.lang_pred for r in langid.predict(df, none, {"doc_id": "long"}).collect()} == {"und"}
    rejected = langid.predict(df, langid.fit(df), {"doc_id": "long"}, reject_at=1.0).collect()
    assert {r.lang_pred for r in rejected} == {"und"}
    assert langid.predict(df.limit(0), none, {"doc_id": "long"}).collect() == []


# -- language model


def test_lm_counts_and_scores(spark, monkeypatch):
    monkeypatch.setattr(brown_lm, "HEAD_WORDS", 60)  # most words come through the join
    df = frame(spark, ROWS)
    train = df.filter("doc_id % 5 <> 1")
    model, vocabulary = brown_lm.fit(train)
    got = brown_lm.score(df, model, vocabulary).collect()
    counts = Counter()
    for i, t in ROWS:
        if i % 5 != 1:
            counts.update(words_of(t) + [b""])
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(ROWS)
    texts = dict(ROWS)
    for r in got:
        words = words_of(texts[r.doc_id]) + [b""]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        assert math.isclose(r.base_score, base, rel_tol=1e-9, abs_tol=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(w in counts for w in words), n)
        assert r.score < 0
    # Every training word has a class; only unseen words take that of their ending.
    place = {w: i for i, w in enumerate(model["words"])}
    rare = {bytes(r.word): (r.n, r["class"]) for r in vocabulary.collect()}
    assert set(place) | set(rare) | {b""} == set(counts) and not set(place) & set(rare)
    assert {w: n for w, (n, _) in rare.items()} == {w: counts[w] for w in rare}
    value = lambda w: -1 if not w else place.get(w, len(place) + brown_lm.shape(w))
    seed = lambda w: int(model["seed"][value(w)])
    class_of = lambda w: rare[w][1] if w in rare else int(model["class_of"][value(w)])
    trained = [[b"", *words_of(t), b""] for i, t in ROWS if i % 5 != 1]
    # The class of a word, from its own neighbours.
    around = {}
    for t in trained:
        for before, w, after in zip(t, t[1:-1], t[2:], strict=False):
            around.setdefault(w, []).append((seed(before), seed(after)))
    says = brown_lm.evidence(model["seed_pairs"])
    for w, seen in around.items():
        if place.get(w, brown_lm.TOP_WORDS) < brown_lm.TOP_WORDS:
            assert class_of(w) == seed(w)
            continue
        total = brown_lm.ending_evidence(model["seed_pairs"], int(model["seed"][len(place) + brown_lm.shape(w)]))
        total = np.round(total + sum(says[left * brown_lm.CLASSES + right] for left, right in seen), 6)
        assert math.isclose(total[class_of(w)], total.max(), abs_tol=1e-5)
    # Transitions, emissions and the score of every text.
    pairs = np.zeros((brown_lm.CLASSES, brown_lm.CLASSES))
    for t in trained:
        for x, y in zip(t, t[1:], strict=False):
            if x in rare and y in rare:
                pairs[class_of(x), seed(y)] += 0.5
                pairs[seed(x), class_of(y)] += 0.5
            else:
                pairs[class_of(x), class_of(y)] += 1
    share = (pairs.sum(axis=0) + 1) / (pairs.sum() + brown_lm.CLASSES)
    moves = (pairs + 20 * share) / (pairs.sum(axis=1, keepdims=True) + 20)
    assert np.allclose(moves, 10 ** model["transition"]) and np.allclose(moves.sum(axis=1), 1)
    mass, types = np.zeros(brown_lm.CLASSES), np.zeros(brown_lm.CLASSES)
    for w, c in counts.items():
        mass[class_of(w)] += c
        types[class_of(w)] += 1
    open_class = {int(c) for c in model["class_of"][len(place) + 1 + brown_lm.TOP_WORDS : -1]}
    under = np.array([mass[k] + 0.5 * (types[k] + (k in open_class)) for k in range(brown_lm.CLASSES)])
    for r in got:
        at, want = 0, 0.0
        for w in words_of(texts[r.doc_id]) + [b""]:
            to = class_of(w)
            want += math.log10(moves[at, to]) + math.log10((counts[w] + 0.5) / under[to])
            at = to
        assert math.isclose(r.score, want, rel_tol=1e-9, abs_tol=1e-9)


def test_lm_frequent_words_have_classes(spark, monkeypatch):
    """Words behind the seed's, counted in ranges, take the class that the join
    of rare words gives them."""
    top = 20
    monkeypatch.setattr(brown_lm, "RANGE", 16)
    monkeypatch.setattr(brown_lm, "TOP_WORDS", top)
    monkeypatch.setattr(brown_lm, "SYMBOLS", 1 + top + brown_lm.SHAPES)
    df = frame(spark, ROWS).repartition(5)
    one, _ = brown_lm.fit(df)
    monkeypatch.setattr(brown_lm, "HEAD_WORDS", top + 40)
    two, rare = brown_lm.fit(df)
    joined = {bytes(r.word): r["class"] for r in rare.collect()} | dict(zip(two["words"], two["class_of"].tolist(), strict=False))
    assert len(one["words"]) > len(two["words"])
    assert dict(zip(one["words"], one["class_of"].tolist(), strict=False)) == joined
    a, b = (sorted((r.doc_id, r.n_known, round(r.score, 6)) for r in brown_lm.score(df, *m).collect()) for m in ((one, df.sparkSession.createDataFrame([], "word binary, n long, class long")), (two, rare)))
    assert [x[:2] for x in a] == [x[:2] for x in b]  # transitions between two rare words differ


def test_exchange_separates_two_languages():
    pairs = np.zeros((9, 9), dtype=np.int64)
    for group in ((1, 2, 3, 4), (5, 6, 7, 8)):
        for a in group:
            pairs[0, a] = pairs[a, 0] = 3
            for b in group:
                pairs[a, b] = 20 + a
    mine = brown_lm.exchange(pairs, 3, 10)
    assert mine[0] == 0 and len(set(mine[1:5])) == len(set(mine[5:])) == 1 and mine[1] != mine[5]


def test_lm_empty(spark):
    model, vocabulary = brown_lm.fit(empty(spark))
    got = brown_lm.score(frame(spark, ROWS[:6]), model, vocabulary).collect()
    assert len(got) == 6 and all(r.n_known == 0 and r.train_tokens == 0 and abs(r.base_score) < 1e-12 for r in got)
    assert brown_lm.score(empty(spark), model, vocabulary).collect() == []


def test_crc_fold_is_zlib(spark):
    got = spark.range(50).select("id", (F.crc32(F.col("id").cast("string")) % 5).alias("m")).collect()
    assert all(r.m == zlib.crc32(str(r.id).encode()) % 5 for r in got)


# -- nearest neighbours


def test_ann_recall_and_ties(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 24)).astype(np.float32)
    x[300:700] = x[20]  # a very common vector
    rows = [(int(i), [float(f) for f in v], "clash") for i, v in enumerate(x)]
    rows += [(2000, None, ""), (2020, [], ""), (2040, [0.0] * 24, ""), (2060, [float("nan")] * 24, ""), (2080, [None] * 24, ""), (2100, [1.0, 2.0], ""), (None, rows[0][1], ""), rows[20], rows[20]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, `block` string")
    got = {}
    for r in ann.nearest(df, F.col("id") % 20 == 0, 20).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert not any(q >= 2000 for q in got)
    recall = []
    d = x.astype(float)
    for q in range(0, 1500, 20):
        found = sorted(got[q])
        s = d @ d[q]
        s[q] = -np.inf
        best = np.lexsort((np.arange(1500), -s))[:20]
        assert [f[0] for f in found] == list(range(1, 21)) and len({f[1] for f in found}) == 20
        assert np.allclose([f[2] for f in found], s[[f[1] for f in found]], rtol=1e-12)
        assert [(-f[2], f[1]) for f in found] == sorted((-f[2], f[1]) for f in found)
        recall.append(len({f[1] for f in found} & set(best.tolist())) / 20)
    assert np.mean(recall) >= 0.9
    assert [f[1] for f in sorted(got[20])][:20] == list(range(300, 320))
    few = spark.createDataFrame(rows[:7], df.schema)
    assert ann.nearest(few, F.col("id") % 20 == 0, 20).count() == 6
    assert ann.nearest(df.limit(0), F.col("id") % 20 == 0, 20).collect() == []

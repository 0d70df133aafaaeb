"""Small nasty tables for the training-data operators."""

import random

CLASH = ["k", "f", "id", "uid", "h", "key", "words", "item", "n", "start", "_text", "_k", "kept", "label"]


def vocabulary(rng, n=400):
    parts = ["an", "be", "ti", "ou", "re", "sh", "lo", "én", "ß", "ka"]
    return ["".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(n)]


def documents(seed=3):
    """(doc_id, text) rows: null, empty and blank texts, one word, copies, near
    copies, shared passages, a long text, unusual bytes, a repeated row."""
    rng = random.Random(seed)
    words = vocabulary(rng)
    say = lambda n: " ".join(rng.choices(words, k=n))
    texts = [None, "", "  \n\t ", "Word", "two words", "Two WORDS", "a b c", "a b c d e", "\x00 \x1c İ ΣΣ", "😀 é ü"]
    base = [say(120) for _ in range(6)]
    texts += base + [base[0], base[0].upper(), base[0].replace(" ", "\n", 3)]
    for b in base[:3]:
        for _ in range(5):
            w = b.split()
            for _ in range(rng.randint(1, 4)):
                w[rng.randrange(len(w))] = rng.choice(words)
            texts.append(" ".join(w))
    passage = say(60)
    texts += ["\n".join([say(9), passage, say(8), line]) for line in [say(20)] * 3 + [say(20)]]
    lines = [say(rng.randint(1, 14)) for _ in range(30)]
    texts += ["\n".join(rng.choices(lines, k=rng.randint(1, 6))) for _ in range(20)]
    texts += ["\n\n" + lines[0] + "\n", "x" * 700, "ab" * 400, say(20_000)]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [rows[10], rows[3]]


def frame(spark, rows, name="doc_id"):
    """The rows with extra columns whose names clash with internal ones."""
    schema = f"{name} long, text string, " + ", ".join(f"`{c}` string" for c in CLASH)
    return spark.createDataFrame([(*r, *CLASH) for r in rows], schema)


def empty(spark, name="doc_id"):
    return frame(spark, [], name)


def words_of(text):
    return (text or "").encode().lower().split()


def shingles_of(text, k):
    w = words_of(text)
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < k else frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))

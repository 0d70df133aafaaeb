"""Benchmark decontamination by SimHash windows (DataFrame functions only).

A benchmark item is a bag of 5-word shingles (the whole sequence, if it has
fewer words); a shingle weighs the logarithm of its length.  A document is
compared in item-sized windows.  A window of similarity t shares at least t of
an item's weight with it; running sums over the shared shingles' places give
the shared weight of every window, and all windows that share enough are formed.
Each window and item has a 64-bit SimHash of its weighted shingles, the second
and later occurrences of one as shingles of their own.
Fingerprints are cut into ``RADIUS + 1`` blocks; two fingerprints
within the radius agree in at least one, so joining on blocks finds them all.
Candidates are verified by the exact weighted Jaccard similarity of the bags.

At the threshold of 0.8 the expected distance is 9.7 of 64 bits with a standard
deviation of 2.9; the radius is 19.

Edge cases: null, empty and wordless texts and items match nothing; a document
shorter than an item is one window; very long texts are read whole; rows that
repeat an id and a text give one result; repeated items keep their own ids; a
null id never matches; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, small, stored

SHINGLE = 5
BITS = 64
RADIUS = 19
UNIT = 1 << 20  # weights in whole units, so that running sums are exact
SPACES = " \t\n\x0b\f\r"


def words(text: Column) -> Column:
    """Lower-cased words; no word gives an empty array."""
    plain = F.btrim(F.lower(text), F.lit(SPACES))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, "[ \\t\\n\\x0B\\f\\r]+"))


def bound(value: Column, use) -> Column:
    """use(value) with value computed once for each row (a one-element
    transform binds it, so the optimiser cannot copy it into a lambda)."""
    return F.transform(F.array(value), use)[0]


def shingle_hashes(all_words: Column, k: int) -> Column:
    """xxhash64 of each run of k words, in order."""
    return bound(all_words, lambda w: F.transform(
        F.slice(w, 1, F.greatest(F.size(w) - (k - 1), F.lit(0))),
        lambda a, i: F.xxhash64(a, *(F.get(w, i + j) for j in range(1, k))),
    ))


def weighted_shingles(w: Column, k: Column) -> Column:
    """array<struct<h,w>> of the runs of k words: hash and weight."""
    return F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(w) - k + 1, F.lit(1))),
        lambda i: bound(F.slice(w, i, k), lambda s: F.struct(F.xxhash64(s).alias("h"), F.log1p(F.length(F.array_join(s, " "))).alias("w"))),
    )


def bags(df: DataFrame) -> DataFrame:
    """(key, h, w, tf) of frames (key, words, k)."""
    rows = df.select("key", F.explode(weighted_shingles(F.col("words"), F.col("k"))).alias("s")).select("key", "s.h", "s.w")
    return rows.groupBy("key", "h").agg(F.first("w").alias("w"), F.count("*").alias("tf"))


def simhash(bag: DataFrame) -> DataFrame:
    """(key, print, total): the fingerprint and the weight of each bag.  Each
    occurrence of a shingle votes with a hash of its own, so that a repeated
    one does not outvote the rest; bags share the first min(tf) of them."""
    units = bag.select("key", "w", "h", F.explode(F.sequence(F.lit(1).cast("long"), "tf")).alias("nth"))
    units = units.select("key", "w", F.when(F.col("nth") == 1, F.col("h")).otherwise(F.xxhash64("h", "nth")).alias("h"))
    sums = [F.sum(F.when(F.getbit("h", F.lit(i)) == 1, F.col("w")).otherwise(-F.col("w"))).alias(f"s{i}") for i in range(BITS)]
    got = units.groupBy("key").agg(F.sum("w").alias("total"), *sums)
    bits = F.lit(0).cast("long")
    for i in range(BITS):
        bits = bits.bitwiseOR(F.when(F.col(f"s{i}") > 0, F.shiftleft(F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    return got.select("key", bits.alias("print"), "total")


def blocks(print_: Column) -> Column:
    """RADIUS + 1 (number, value) blocks that together cover all bits."""
    n = RADIUS + 1
    edges = [round(i * BITS / n) for i in range(n + 1)]
    return F.array(*[
        F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(print_, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)).alias("value"))
        for i, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False))
    ])


def similar_starts(doc: DataFrame, item: DataFrame, item_bags: DataFrame, sizes: list[int], threshold: float) -> DataFrame:
    """(d, n, k, s, last): runs of window starts, from s to last, whose windows
    share so much weight with an item that they may reach the threshold."""
    needed = item_bags.groupBy("key").agg(F.floor(F.sum(F.col("w") * F.col("tf")) * threshold * UNIT).alias("needed"))
    of_bags = item_bags.join(item.select("key", F.size("words").alias("n"), "k"), "key").select(F.col("key").alias("b"), "h", "w", "tf", "n", "k")
    of_bags = small(stored(of_bags, "benchmark-shingles"))
    hits = None
    for k in sizes:
        at = doc.select("d", F.posexplode(shingle_hashes(words(F.col("text")), k)).alias("p", "h"))
        hit = at.join(of_bags.filter(F.col("k") == k), "h").select("d", "b", "n", "k", "h", "w", "tf", "p")
        hits = hit if hits is None else hits.unionAll(hit)

    # A window from s on gains the weight of an occurrence at p for p - (n - k)
    # <= s <= p, unless it holds tf earlier ones of that shingle.
    seen = hits.groupBy("d", "b", "n", "k", "h", "w", "tf").agg(F.sort_array(F.collect_set("p")).alias("ps"))
    spans = seen.select("d", "b", "n", "k", F.ceil(F.col("w") * UNIT).alias("w"), F.inline(F.transform("ps", lambda p, i: F.struct(
        p.alias("p"), F.greatest(p - F.col("n") + F.col("k"), F.coalesce(F.get("ps", (i - F.col("tf")).cast("int")), p - F.col("n")) + 1).alias("from")
    ))))
    steps = spans.filter("from <= p").select("d", "b", "n", "k", F.inline(F.array(
        F.struct(F.col("from").alias("s"), F.col("w").alias("change")), F.struct((F.col("p") + 1).alias("s"), (-F.col("w")).alias("change"))
    ))).groupBy("d", "b", "n", "k", "s").agg(F.sum("change").alias("change"))
    by_start = Window.partitionBy("d", "b").orderBy("s")
    shared = steps.select("d", "b", "n", "k", "s", F.sum("change").over(by_start).alias("shared"), (F.lead("s").over(by_start) - 1).alias("last"))
    enough = shared.join(small(stored(needed.select(F.col("key").alias("b"), "needed"), "benchmark-needs")), "b").filter("shared >= needed")
    return enough.select("d", "n", "k", "s", "last").distinct()


def matches(docs: DataFrame, items: DataFrame, threshold: float = 0.8, id_column: str = "doc_id", text: str = "text",
            item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, item, similarity): the best window of each document for each item
    it reaches the threshold with."""
    item = items.filter(F.col(item_column).isNotNull()).select(F.col(item_column).alias("item"), words(F.col(item_text)).alias("words")).filter(F.size("words") > 0)
    item = stored(item.dropDuplicates().select(F.monotonically_increasing_id().alias("key"), "item", "words", F.least(F.size("words"), F.lit(SHINGLE)).alias("k")), "benchmark")
    sizes = sorted(r[0] for r in item.select("k").distinct().collect())  # at most SHINGLE values
    doc = docs.filter(F.col(id_column).isNotNull()).select(F.col(id_column).alias("id"), F.xxhash64(id_column, text).alias("d"), F.col(text).alias("text"))

    if not sizes:
        return doc.select("id", F.lit(None).cast(dict(items.dtypes)[item_column]).alias("item"), F.lit(0.0).alias("similarity")).limit(0)
    item_bags = stored(bags(item.select("key", "words", "k")), "benchmark-bags")
    starts = stored(similar_starts(doc, item, item_bags, sizes, threshold), "windows")
    hit_docs = small(stored(starts.select("d").distinct(), "hit-documents"))

    # The windows, moved inside the document where they reach over its ends.
    found = doc.join(hit_docs, "d").select("id", "d", words(F.col("text")).alias("words")).dropDuplicates(["id", "d"])
    inside = lambda s: F.greatest(F.least(F.col(s), F.size("words") - F.col("n")), F.lit(0))
    window = found.join(starts, "d").select("id", "words", "n", "k", F.explode(F.sequence(inside("s"), inside("last"))).alias("start"))
    window = window.select("id", F.slice("words", F.col("start") + 1, F.col("n")).alias("words"), "k").distinct()
    window = stored(window.select(F.xxhash64("id", "words", "k").alias("key"), "id", "words", "k"), "window-words")
    window_bags = stored(bags(window.select("key", "words", "k")), "window-bags")
    window_prints, item_prints = stored(simhash(window_bags), "window-prints"), stored(simhash(item_bags), "benchmark-prints")

    # All pairs of fingerprints within the radius share a block.
    cut = lambda p, side: p.select(F.col("key").alias(side), F.col("print").alias(f"{side}_print"), F.col("total").alias(f"{side}_total"), F.inline(blocks(F.col("print"))))
    near = cut(window_prints, "a").join(small(stored(cut(item_prints, "b"), "benchmark-blocks")), ["block", "value"])
    near = near.filter(F.bit_count(F.col("a_print").bitwiseXOR(F.col("b_print"))) <= RADIUS).select("a", "b", "a_total", "b_total").distinct()

    # Exact weighted Jaccard similarity of the candidates.
    shared = near.join(window_bags.select(F.col("key").alias("a"), "h", "w", "tf"), "a").join(
        item_bags.select(F.col("key").alias("b"), F.col("h").alias("h_b"), F.col("tf").alias("tf_b")).withColumnRenamed("h_b", "h"), ["b", "h"]
    )
    both = shared.groupBy("a", "b", "a_total", "b_total").agg(F.sum(F.col("w") * F.least("tf", "tf_b")).alias("both"))
    similar = both.select("a", "b", (F.col("both") / (F.col("a_total") + F.col("b_total") - F.col("both"))).alias("similarity")).filter(F.col("similarity") >= threshold - 1e-12)
    return (
        similar.join(window.select(F.col("key").alias("a"), "id").distinct(), "a")
        .join(item.select(F.col("key").alias("b"), "item"), "b")
        .groupBy("id", "item").agg(F.round(F.max("similarity"), 9).alias("similarity"))
    )


def clean(docs: DataFrame, items: DataFrame, threshold: float = 0.8, text: str = "text", item_column: str = "item_id") -> DataFrame:
    """docs without those that hold a window similar to an item.  What a
    document holds is decided by its text alone, whatever its id."""
    of_text = F.sha2(F.col(text), 256)
    leaks = stored(matches(docs.select(of_text.alias("id"), F.col(text).alias("text")), items, threshold, "id", "text", item_column).select("id").distinct(), "leaks")
    digest = fresh("digest", docs.columns)
    return docs.withColumn(digest, of_text).join(leaks.withColumnRenamed("id", digest), digest, "left_anti").drop(digest)

"""Source divergence audit: how far the sources of a language are apart.

Terms are runs of letters and non-ASCII characters, A-Z lower-cased.  A language
keeps the V terms that at least ``least_docs`` of its documents hold.  Every
source of a language, and the language itself, gives a kept term with ``n``
occurrences the share ``p = 1 + floor(SCALE (n + PRIOR) / (N + PRIOR V))``, N
being its occurrences of kept terms.  Reported are the distance of every two
sources (the sum of |p - p'| over all kept terms), and for every source the
terms that it has more of than its language.

Identical texts are collapsed first: a grouping of (lang, digest of the text,
source) gives every text its multiplicity in each source, without moving a
text.  A text that occurs once is counted where it is read.  Of one that occurs
again a task passes on one copy, the copies meet in a grouping with map-side
combine, and the text is cut into terms once; its counts and document
frequencies are multiplied by its multiplicities.  (A bitmap routes the texts; a
unique one that it mistakes for a repeated one takes the longer way, with the
same result.)

Pairs are evaluated sparsely.  A term that a source lacks has its share ``z``
for n = 0, so the distance of a and b is

    sum over a's terms |pa - zb| + sum over b's terms |pb - za|
    + (V - |a's terms| - |b's terms|) |za - zb|
    + sum over common terms (|pa - pb| - |pa - zb| - |pb - za| + |za - zb|)

The first two sums need only how often each share occurs in a source; only the
last meets terms, by an equality join on (lang, term), which holds at most one
row for a source.  All numbers are whole, products are decimals of 38 digits.

Edge cases: null texts, languages and sources are empty strings; a group
without kept terms has no row of part ``term``, and distances like any other
(0 if V is 0); a language of one source has no pair; repeated rows count as
often as they are there; ids are not looked at; very long texts are read whole;
ties go to the smaller item by its UTF-8 bytes; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import textops
from .common import by_value, key_filter, maybe_in, small, stored

by_value(__name__)

LEAST_DOCS = 30
PRIOR = 5
SCALE = 1_000_000_000
TOP = 50
PIECE = 1 << 22  # bytes of a text that are cut into terms at once
FLUSH_ROWS = 2_000_000
SEEN_TEXTS = 1_000_000

# Letters stay, A-Z lower-cased, as do all bytes of longer characters; the rest separates.
_TERM = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def term_counts(text: bytes) -> Counter:
    """Occurrences of each term, as bytes."""
    plain = text.translate(_TERM)
    found: Counter = Counter()
    at = 0
    while at < len(plain):
        to = plain.find(b" ", at + PIECE) if at + PIECE < len(plain) else -1
        to = len(plain) if to < 0 else to
        found.update(plain[at:to].split())
        at = to
    return found


class Gathered:
    """Term counts of (lang, source) groups, added up from time to time."""

    NAMES = ["lang", "source", "term", "n", "docs"]

    def __init__(self):
        self.groups: dict[tuple[str, str], int] = {}
        self.open: tuple[list, list, list, list] = ([], [], [], [])
        self.closed: list[pa.Table] = []
        self.rows = 0

    def add(self, lang: str, source: str, found: Counter, times: int = 1) -> None:
        group, term, n, docs = self.open
        group.extend([self.groups.setdefault((lang, source), len(self.groups))] * len(found))
        term.extend(found)
        n.extend(found.values() if times == 1 else [c * times for c in found.values()])
        docs.extend([times] * len(found))
        self.rows += len(found)

    def close(self) -> None:
        """Python objects become arrays."""
        if self.open[0]:
            group, term, n, docs = self.open
            self.closed.append(pa.table({"g": pa.array(group, pa.int32()), "term": pa.array(term, pa.binary()), "n": pa.array(n, pa.int64()), "docs": pa.array(docs, pa.int64())}))
            self.open = ([], [], [], [])

    def flush(self) -> pa.RecordBatch:
        """The sums so far, and begin anew."""
        self.close()
        columns = [pa.nulls(0, t) for t in (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())]
        if self.closed:
            t = pa.concat_tables(self.closed).group_by(["g", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")]).combine_chunks()
            names = list(self.groups)
            lang, source = (pa.array([k[i] for k in names], pa.string()).take(t["g"].combine_chunks()) for i in (0, 1))
            columns = [lang, source, t["term"].combine_chunks().view(pa.string()), t["n_sum"].combine_chunks(), t["docs_sum"].combine_chunks()]
        self.groups, self.closed, self.rows = {}, [], 0
        return pa.record_batch(columns, names=self.NAMES)


def _unique_texts(repeated):
    """Of (lang, source, k, digest, text): counts of the texts that occur once,
    and rows (lang, digest, text) of those that may occur again, one a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, seen = Gathered(), set()
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
        names = [*Gathered.NAMES, "digest", "text"]

        def counts() -> pa.RecordBatch:
            b = gathered.flush()
            return pa.record_batch([*b.columns, pa.nulls(b.num_rows, pa.binary()), pa.nulls(b.num_rows, pa.string())], names=names)

        for b in batches:
            offsets, data = textops.columns(b.column(4))
            again = maybe_in(repeated.value, b.column(2).to_numpy())
            langs, sources, digests = (b.column(i).to_pylist() for i in (0, 1, 3))
            passed = []
            for i, is_again in enumerate(again):
                if not is_again:
                    gathered.add(langs[i], sources[i], term_counts(data[offsets[i] : offsets[i + 1]].tobytes()))
                elif (langs[i], digests[i]) not in seen:
                    seen.add((langs[i], digests[i]))
                    passed.append(i)
            gathered.close()
            if passed:
                at = pa.array(passed, pa.int64())
                none = [pa.nulls(len(passed), t) for t in kinds[1:5]]
                yield pa.record_batch([b.column(0).take(at), *none, b.column(3).take(at), b.column(4).take(at)], names=names)
            if gathered.rows > FLUSH_ROWS:
                yield counts()
            if len(seen) > SEEN_TEXTS:
                seen.clear()
        yield counts()

    return run


def _copied_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (lang, sources, text): counts times the multiplicity in each source."""
    gathered = Gathered()
    for b in batches:
        offsets, data = textops.columns(b.column(2))
        langs, sources = b.column(0).to_pylist(), b.column(1).to_pylist()
        for i in range(b.num_rows):
            found = term_counts(data[offsets[i] : offsets[i + 1]].tobytes())
            for s in sources[i]:
                gathered.add(langs[i], s["source"], found, s["times"])
                if gathered.rows > FLUSH_ROWS:
                    yield gathered.flush()
        gathered.close()
    yield gathered.flush()


def term_table(df: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(groups, counts): groups (lang, source) that occur; counts (lang, source,
    term, n, docs), which may have several rows for a key."""
    kind = "lang string, source string, term string, n long, docs long"
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = df.select(plain(lang).alias("lang"), plain(source).alias("source"), plain(text).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256))).withColumn("k", F.xxhash64("lang", "digest"))
    times = stored(rows.groupBy("lang", "digest", "k", "source").agg(F.count("*").alias("times")), "divergence-multiplicities")
    again = times.groupBy("lang", "digest", "k").agg(F.sum("times").alias("times")).filter("times > 1").select("k")
    repeated = df.sparkSession.sparkContext.broadcast(key_filter(again))
    scanned = rows.select("lang", "source", "k", "digest", "text").mapInArrow(_unique_texts(repeated), f"{kind}, digest binary, text string")
    scanned = stored(scanned, "divergence-terms")
    texts = scanned.filter(F.col("digest").isNotNull()).groupBy("lang", "digest").agg(F.max("text").alias("text"))
    sources = times.groupBy("lang", "digest").agg(F.collect_list(F.struct("source", "times")).alias("sources"))
    copied = texts.join(sources, ["lang", "digest"]).select("lang", "sources", "text").mapInArrow(_copied_texts, kind)
    once = scanned.filter(F.col("digest").isNull()).select("lang", "source", "term", "n", "docs")
    return times.select("lang", "source").distinct(), once.unionByName(copied)


def share(n: str, total: str, kept: str):
    """p of n occurrences, of total, with kept terms in the language."""
    return F.expr(f"1L + (cast({SCALE} as decimal(10,0)) * cast({n} + {PRIOR} as decimal(20,0))) div cast({total} + {PRIOR} * {kept} as decimal(20,0))")


def audit(df: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """lang, source, part, item, value, rank."""
    groups, counts = term_table(df, lang, source, text)
    of_term = W.partitionBy("lang", "term")
    # One exchange by (lang, term) serves the sums by source and those by language.
    summed = counts.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    placed = summed.select("lang", "term", "source", "n", F.sum("docs").over(of_term).alias("docs"), F.sum("n").over(of_term).alias("lang_n"),
                           (F.min("source").over(of_term) == F.col("source")).alias("first"))
    kept = stored(placed.filter(F.col("docs") >= least_docs).drop("docs"), "divergence-kept")

    langs = kept.groupBy("lang").agg(F.count_if("first").alias("kept"), F.sum("n").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("terms"))
    zero = F.lit(0).cast("long")
    sizes = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", *(F.coalesce(c, zero).alias(c) for c in ("total", "terms", "kept", "lang_total"))
    )
    sizes = stored(sizes.withColumn("z", F.when(F.col("kept") > 0, share("0", "total", "kept")).otherwise(zero)), "divergence-groups")
    shares = kept.join(small(sizes), ["lang", "source"]).select(
        "lang", "source", "term", "z", share("n", "total", "kept").alias("p"), share("lang_n", "lang_total", "kept").alias("q")
    )

    by_value_ = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = shares.filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(by_value_)).filter(F.col("rank") <= top)

    # Distances of unordered pairs (a < b), as sums of their three parts.
    apart = lambda x, y: F.abs(F.col(x) - F.col(y))
    one, two = (sizes.select("lang", *(F.col(c).alias(f"{c}_{s}") for c in ("source", "terms", "z")), "kept") for s in "ab")
    lacking = one.join(two.drop("kept"), "lang").filter("source_a < source_b").select(
        "lang", F.col("source_a").alias("a"), F.col("source_b").alias("b"),
        ((F.col("kept") - F.col("terms_a") - F.col("terms_b")) * apart("z_a", "z_b")).alias("value"),
    )
    steps = stored(shares.groupBy("lang", "source", "p").agg(F.count("*").alias("terms")), "divergence-steps")
    other = small(sizes.select("lang", F.col("source").alias("other"), F.col("z").alias("z_other")))
    alone = steps.join(other, "lang").filter("source != other").groupBy("lang", "source", "other").agg(F.sum(F.col("terms") * apart("p", "z_other")).alias("value"))
    alone = alone.select("lang", F.least("source", "other").alias("a"), F.greatest("source", "other").alias("b"), "value")
    x, y = (shares.select("lang", "term", *(F.col(c).alias(f"{c}_{s}") for c in ("source", "z", "p"))) for s in "ab")
    common = x.join(y, ["lang", "term"]).filter("source_a < source_b").groupBy("lang", F.col("source_a").alias("a"), F.col("source_b").alias("b")).agg(
        F.sum(apart("p_a", "p_b") - apart("p_a", "z_b") - apart("p_b", "z_a") + apart("z_a", "z_b")).alias("value")
    )
    total = lacking.unionByName(alone).unionByName(common).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    pairs = total.select("lang", "value", F.inline(F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))
    ))).withColumn("rank", F.row_number().over(by_value_))

    columns = lambda part: ["lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"), "rank"]
    return pairs.select(*columns("pair")).unionByName(terms.select(*columns("term")))

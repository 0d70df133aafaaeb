"""Chat formatting by schema fingerprint (DataFrame functions only).

A layout is a declarative mapping from one prompt, instruction or message
schema to canonical turns.  The nested field paths that layouts know are
hashed; the hash selects the mapping.  ``canonical_turns`` fingerprints a
typed DataFrame once, ``canonical_records`` fingerprints every JSON record, so
one column may mix layouts.

The template writes each turn as ``### role: text</turn>\\n``.  Inside texts
and roles every backslash and every control string is replaced by a backslash
code, so the markers occur only as markers and reading back is exact.

Edge cases: null text or role counts as empty; rows with a null or repeated
turn number are ordered by (turn, role, text), nulls first; repeated rows stay
repeated turns; an empty table gives an empty result; extra columns are
ignored, also when their names clash with another layout's (the layout with
the most matching paths wins).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

# Control strings of the template and their codes; the backslash comes first
# when writing and last when reading.
CODES = (("\\", "\\b"), ("</turn>", "\\e"), ("### ", "\\h"))
ROLE_CODES = (*CODES, (":", "\\c"))
TURN_END = "</turn>\n"
TURN = "struct<turn:bigint,role:string,text:string>"

# Names under which datasets call the speakers.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

# layout: nested field paths that define it
LAYOUTS: dict[str, tuple[str, ...]] = {
    "turn_rows": ("role", "text", "turn"),
    "messages": ("messages[].content", "messages[].role"),
    "sharegpt": ("conversations[].from", "conversations[].value"),
    "instruction_input": ("input", "instruction", "output"),
    "instruction": ("instruction", "output"),
    "prompt_completion": ("completion", "prompt"),
    "prompt_response": ("prompt", "response"),
    "question_answer": ("answer", "question"),
}
KNOWN = sorted({p for paths in LAYOUTS.values() for p in paths})


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


FINGERPRINTS = {fingerprint(paths): name for name, paths in LAYOUTS.items()}


def field_paths(kind: T.DataType, prefix: str = "") -> list[str]:
    """Leaf paths of a schema; an array adds ``[]``."""
    if isinstance(kind, T.StructType):
        dot = f"{prefix}." if prefix else ""
        return [p for f in kind.fields for p in field_paths(f.dataType, dot + f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, prefix + "[]")
    return [prefix]


def layout_of(paths) -> str:
    """The layout with these field paths; else the one with most paths among
    those whose paths are all there."""
    seen = set(paths) & set(KNOWN)
    if (name := FINGERPRINTS.get(fingerprint(seen))) is not None:
        return name
    fits = [n for n, p in LAYOUTS.items() if set(p) <= seen]
    if not fits:
        raise ValueError(f"no chat layout for the fields {sorted(paths)}")
    return max(fits, key=lambda n: len(LAYOUTS[n]))


def _role(c: Column) -> Column:
    low = F.lower(F.coalesce(c, F.lit("")))
    out = low
    for name, canonical in ROLES.items():
        out = F.when(low == name, F.lit(canonical)).otherwise(out)
    return out


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def _pair(user: Column, assistant: Column) -> Column:
    turn = lambda i, role, c: F.struct(F.lit(i).cast("bigint").alias("turn"), F.lit(role).alias("role"), _text(c).alias("text"))
    return F.array(turn(0, "user", user), turn(1, "assistant", assistant))


def _listed(items: Column, role: str, text: str) -> Column:
    return F.coalesce(
        F.transform(items, lambda m, i: F.struct(i.cast("bigint").alias("turn"), _role(m[role]).alias("role"), _text(m[text]).alias("text"))),
        F.array().cast(f"array<{TURN}>"),
    )


def _with_input(get: Callable[[str], Column]) -> Column:
    extra = _text(get("input"))
    return F.when(extra == "", _text(get("instruction"))).otherwise(F.concat_ws("\n", _text(get("instruction")), extra))


# layout: turns as an expression over a getter of the layout's columns
MAPPINGS: dict[str, Callable[[Callable[[str], Column]], Column]] = {
    "messages": lambda get: _listed(get("messages"), "role", "content"),
    "sharegpt": lambda get: _listed(get("conversations"), "from", "value"),
    "instruction_input": lambda get: _pair(_with_input(get), get("output")),
    "instruction": lambda get: _pair(get("instruction"), get("output")),
    "prompt_completion": lambda get: _pair(get("prompt"), get("completion")),
    "prompt_response": lambda get: _pair(get("prompt"), get("response")),
    "question_answer": lambda get: _pair(get("question"), get("answer")),
}

RECORD_SCHEMA = (
    "messages array<struct<role:string,content:string>>, conversations array<struct<`from`:string,value:string>>, "
    "instruction string, `input` string, output string, prompt string, completion string, response string, question string, answer string"
)


def canonical_turns(df: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """(conv_id, turn, role, text) rows from a typed DataFrame of any layout."""
    layout = layout_of(field_paths(df.schema))
    if layout == "turn_rows":
        return df.select(
            F.col(conv_id).alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
            F.coalesce("role", F.lit("")).alias("role"), _text(F.col("text")).alias("text"),
        )
    turns = MAPPINGS[layout](F.col).alias("t")
    return df.select(F.col(conv_id).alias("conv_id"), turns).select("conv_id", F.inline("t"))


def record_fingerprint(json: Column) -> Column:
    """sha256 of the known nested field paths of one JSON record."""
    keys = lambda j: F.coalesce(F.json_object_keys(j), F.array().cast("array<string>"))
    within = lambda name: F.transform(keys(F.get_json_object(json, f"$.{name}[0]")), lambda k: F.concat(F.lit(f"{name}[]."), k))
    nested = [within(name) for name in ("messages", "conversations")]
    known = F.array(*[F.lit(p) for p in KNOWN])
    return F.sha2(F.array_join(F.array_sort(F.array_intersect(F.concat(keys(json), *nested), known)), "\n"), 256)


def canonical_records(df: DataFrame, conv_id: str, json: str) -> DataFrame:
    """(conv_id, turn, role, text, layout) rows from JSON records that may mix
    layouts.  A record of no known layout, or that is not JSON, gives one row
    with null turn, role, text and layout, so that none is lost."""
    got = df.select(F.col(conv_id).alias("conv_id"), F.col(json).alias("j"))
    got = got.withColumn("f", record_fingerprint(F.col("j"))).withColumn("r", F.from_json("j", RECORD_SCHEMA))
    turns = layout = None
    for print_, name in FINGERPRINTS.items():
        if name in MAPPINGS:
            is_it, mapped = F.col("f") == print_, MAPPINGS[name](lambda c: F.col(f"r.{c}"))
            turns = F.when(is_it, mapped) if turns is None else turns.when(is_it, mapped)
            layout = F.when(is_it, F.lit(name)) if layout is None else layout.when(is_it, F.lit(name))
    return got.select("conv_id", layout.alias("layout"), F.inline_outer(turns)).select("conv_id", "turn", "role", "text", "layout")


def escape(c: Column, codes=CODES) -> Column:
    for plain, code in codes:
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescape(c: Column, codes=CODES) -> Column:
    for plain, code in reversed(codes):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def format_chat(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans: the whole conversation as one string and
    the (start, length) code-point ranges of the assistant texts in it.

    One exchange on conv_id serves the running offset and the grouping; only
    a conversation's own rows meet, as its output is one string.
    """
    head = F.concat(F.lit("### "), escape(F.col("role"), ROLE_CODES), F.lit(": "))
    parts = turns.select("conv_id", "turn", "role", "text").withColumns({"head": head, "body": escape(F.col("text"))})
    parts = parts.withColumns({
        "n_head": F.length("head").cast("bigint"),
        "n_body": F.length("body").cast("bigint"),
    })
    width = F.col("n_head") + F.col("n_body") + F.lit(len(TURN_END))
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = F.coalesce(F.sum(width).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = parts.withColumns({"at": before, "ord": F.row_number().over(order)})
    one = F.struct(
        "ord",
        F.concat("head", "body", F.lit(TURN_END)).alias("s"),
        F.when(F.col("role") == "assistant", F.struct((F.col("at") + F.col("n_head")).alias("start"), F.col("n_body").alias("length"))).alias("span"),
    )
    listed = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("p"))
    return listed.select(
        "conv_id",
        F.array_join(F.transform("p", lambda x: x["s"]), "").alias("formatted"),
        F.filter(F.transform("p", lambda x: x["span"]), lambda x: x.isNotNull()).alias("loss_spans"),
    )


def read_back(formatted: Column) -> Column:
    """array<struct<role,text>> parsed from a formatted conversation."""
    parts = F.filter(F.split(formatted, TURN_END), lambda p: p != "")

    def turn(p):
        cut = F.instr(p, ": ")
        return F.struct(
            unescape(F.substring(p, F.lit(5), cut - 5), ROLE_CODES).alias("role"),
            unescape(F.substring(p, cut + 2, F.length(p))).alias("text"),
        )

    return F.transform(parts, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped, spans in order."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), ""
    )


def digest(chats: DataFrame) -> DataFrame:
    """Counts and digests of formatted conversations, read back from them."""
    got = chats.withColumns({"t": read_back(F.col("formatted")), "loss": loss_text(F.col("formatted"), F.col("loss_spans"))})
    flat = F.array_join(F.transform("t", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return got.select(
        "conv_id",
        F.size("t").cast("bigint").alias("n_turns"),
        F.sha2(flat, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )

"""Secrets in texts, with weak candidates confirmed by the parts that belong to them.

Strong patterns (assignments, access identifiers, long hex strings) are reported wherever they
match. Weak ones prove nothing alone: a 40-character key, a short assigned value, an endpoint. They
are reported only where their complements lie in the same scope, `radius` code points to either
side: keys and short values need an access identifier, endpoints an access identifier and a key or
value. The join of parts and scopes is a sweep over the parts of a text in order of position, once
forwards and once backwards, that carries the nearest part of each role.

Built-in functions only. Positions come from the pieces between matches (`split`) and the matches
(`regexp_extract_all`): their lengths, summed up, are the code points before each match. Sums and
sweeps run over chunks of pieces, so a text with very many matches costs in proportion to them. Texts
are only taken apart where a cheap test finds the pattern at all; there is no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanrisk.llm.common import only

# The base patterns, in the order in which equal starts are listed.
ASSIGN = (
    r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
# `AKIA[A-Z0-9]+` of 18 characters or more, and `[0-9a-f]+` of 16 or more. A match ends where its
# run of characters ends, so asking for the length within the pattern finds the same matches.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
LEAST_VALUE = 12
BASE_KINDS = ("assign", "access", "hex")

# Weak parts. `key` keeps runs of exactly 40 characters, `short` values of 6 to 11.
KEY = r"[A-Za-z0-9/+]{40,}"
ENDPOINT = r"https?://[A-Za-z0-9.-]+"
LEAST_SHORT = 6
KINDS = (*BASE_KINDS, "key", "short", "endpoint")
RADIUS = 300

SPAN = "struct<start:int,rank:int,end:int>"
FAR = -(2**30)


#: Elements that are put together one by one; longer arrays are chunks of chunks.
CHUNK, LEVELS = 64, 2


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often `body` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _scan(
    items: Column,
    state: Column,
    advance: Callable[[Column, Column], Column],
    emit: Callable[[Column, Column], Column],
    state_kind: str,
    kind: str,
    levels: int = LEVELS,
) -> Column:
    """What `emit(state, item)` (an array) gives for each item in turn, where `advance` makes the next
    state. Appending to an array copies it, so long arrays are cut: the states at the begin of the
    chunks come first, and then each chunk is scanned from its own."""
    if not levels:
        start = F.struct(state.cast(state_kind).alias("state"), F.array().cast(f"array<{kind}>").alias("out"))
        step = lambda held, item: F.struct(
            advance(held["state"], item).cast(state_kind).alias("state"),
            F.concat(held["out"], emit(held["state"], item).cast(f"array<{kind}>")).alias("out"),
        )
        return F.aggregate(items, start, step)["out"]

    def over_chunks(chunks: Column) -> Column:
        whole = lambda held, chunk: F.aggregate(chunk, held, lambda x, item: advance(x, item).cast(state_kind))
        states = _scan(chunks, state, whole, lambda held, _: F.array(held), state_kind, state_kind, levels - 1)
        one = lambda chunk, held: _scan(chunk, held, advance, emit, state_kind, kind, 0)
        return F.flatten(F.zip_with(chunks, states, one))

    def cut(values: Column) -> Column:
        last = F.floor(F.greatest(F.size(values) - 1, F.lit(0)) / CHUNK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(values, k * CHUNK + 1, CHUNK))

    return _bound(items, lambda values: _bound(cut(values), over_chunks))


def _spans(text: Column, pattern: str, rank: int, keep=None) -> Column:
    """The matches of a pattern as (start, rank, end), in order of position."""
    pieces = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, hit: F.struct(
            F.length(gap).alias("gap"),
            F.coalesce(F.length(hit), F.lit(0)).alias("hit"),
            (hit.isNotNull() if keep is None else F.coalesce(keep(hit), F.lit(False))).alias("wanted"),
        ),
    )

    def emit(at, piece):
        begin = at + piece["gap"]
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), (begin + piece["hit"]).alias("end"))
        return F.filter(F.array(span), lambda _: piece["wanted"])

    found = _scan(pieces, F.lit(0), lambda at, piece: at + piece["gap"] + piece["hit"], emit, "int", SPAN)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(f"array<{SPAN}>"))


def _value_length(hit: Column) -> Column:
    return F.length(F.regexp_extract(hit, ASSIGN, 2))


def base_spans(text: Column) -> Column:
    """All strong matches as array<(start, rank, end)>, by start and then kind; null text: none."""
    text = F.coalesce(text, F.lit(""))
    strong = _spans(text, ASSIGN, 0, lambda hit: _value_length(hit) >= LEAST_VALUE)
    return F.sort_array(
        F.concat(strong, _spans(text, ACCESS, 1), _spans(text, HEX, 2))
    )


def _weak_spans(text: Column) -> Column:
    def short(hit):
        return (_value_length(hit) >= LEAST_SHORT) & (_value_length(hit) < LEAST_VALUE)

    return F.concat(
        _spans(text, KEY, 3, lambda hit: F.length(hit) == 40),
        _spans(text, ASSIGN, 4, short),
        _spans(text, ENDPOINT, 5),
    )


def _nearest(parts: Column, backwards: bool) -> Column:
    """Give each part the distance to the nearest access identifier and secret on one side."""
    access, secret = ("next_access", "next_secret") if backwards else ("last_access", "last_secret")
    fields = ["start", "rank", "end", "last_access", "last_secret", "next_access", "next_secret"]
    kind = "struct<" + ",".join(f"{f}:int" for f in fields) + ">"
    start = F.struct(F.lit(FAR).alias("access"), F.lit(FAR).alias("secret"))

    def advance(state, part):
        edge = -part["start"] if backwards else part["end"]
        is_access, is_secret = part["rank"] == 1, part["rank"].isin(0, 2, 3, 4)
        return F.struct(
            F.when(is_access, F.greatest(state["access"], edge)).otherwise(state["access"]).alias("access"),
            F.when(is_secret, F.greatest(state["secret"], edge)).otherwise(state["secret"]).alias("secret"),
        )

    def emit(state, part):
        here = -part["end"] if backwards else part["start"]  # coordinates run backwards on the way back
        own = {access: here - state["access"], secret: here - state["secret"]}
        return F.array(F.struct(*[own.get(f, part[f]).cast("int").alias(f) for f in fields]))

    return _scan(F.reverse(parts) if backwards else parts, start, advance, emit, "struct<access:int,secret:int>", kind)


def linked_spans(text: Column, base: Column, radius: int = RADIUS) -> Column:
    """The weak parts of a text that have their complements within `radius`, as `base_spans`."""
    text = F.coalesce(text, F.lit(""))
    none = F.lit(None).cast("int")
    parts = F.transform(
        F.sort_array(F.concat(base, _weak_spans(text))),
        lambda p: F.struct(
            p["start"].alias("start"), p["rank"].alias("rank"), p["end"].alias("end"),
            none.alias("last_access"), none.alias("last_secret"),
            none.alias("next_access"), none.alias("next_secret"),
        ),
    )
    placed = _nearest(_nearest(parts, backwards=False), backwards=True)

    def confirmed(p):
        has_access = F.least(p["last_access"], p["next_access"]) <= radius
        has_secret = F.least(p["last_secret"], p["next_secret"]) <= radius
        return (p["rank"].isin(3, 4) & has_access) | ((p["rank"] == 5) & has_access & has_secret)

    spans = F.transform(
        F.filter(placed, confirmed),
        lambda p: F.struct(p["start"].alias("start"), p["rank"].alias("rank"), p["end"].alias("end")),
    )
    # Every weak part needs an access identifier; other texts are not searched for them.
    return F.when(F.exists(base, lambda p: p["rank"] == 1), spans).otherwise(
        F.array().cast(f"array<{SPAN}>")
    )


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS
) -> DataFrame:
    """One row per input row: `doc_id`, `base` (strong spans) and `spans` (with the linked ones).

    Spans are (start, rank, end): code points, end exclusive, `rank` the place in `KINDS`, sorted by
    start and then kind. Null and empty texts have none; repeated rows and null ids are kept; other
    columns are not read; an empty table gives an empty result. Texts are read whole.
    """
    rows = only(docs, doc_id=id_col, text=text_col).withColumn("base", base_spans(F.col("text")))
    linked = linked_spans(F.col("text"), F.col("base"), radius)
    return rows.withColumn("linked", linked).select(
        "doc_id", "base", F.sort_array(F.concat("base", "linked")).alias("spans")
    )


def spans_as_text(spans: Column) -> Column:
    """`kind:start:end`, comma-joined; empty without spans."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def redact_secrets(
    docs: DataFrame, text_col: str = "text", mask: str = "<SECRET>", radius: int = RADIUS
) -> DataFrame:
    """The same rows and columns with every reported span of the text replaced by `mask`.

    Overlapping spans are masked once. Texts without secrets, null ones included, stay as they are.
    """
    text = F.col(f"`{text_col}`")
    base = docs.withColumn("_secret_base", base_spans(text))
    found = base.withColumn(
        "_secret_spans",
        F.sort_array(F.concat("_secret_base", linked_spans(text, F.col("_secret_base"), radius))),
    )

    # Four bytes a code point, so that a piece is found without counting from the begin. The mark in
    # front of a piece is the one that decoding takes off.
    points = F.encode(text, "UTF-32")
    mark = F.lit(bytes((0, 0, 0xFE, 0xFF)))

    def masked(points):
        def emit(at, span):
            # A span that begins inside the last one only extends it.
            gap = F.substring(points, at * 4 + 1, (span["start"] - at) * 4)
            return F.filter(
                F.array(F.decode(F.concat(mark, gap), "UTF-32"), F.lit(mask)), lambda _: span["start"] >= at
            )

        out = _scan(F.col("_secret_spans"), F.lit(0), lambda at, span: F.greatest(at, span["end"]), emit, "int", "string")
        return F.array_join(out, "")

    end = F.array_max(F.transform("_secret_spans", lambda span: span["end"]))
    whole = F.concat(_bound(points, masked), F.substr(text, end + 1, F.length(text)))
    return found.withColumn(
        text_col, F.when(F.size("_secret_spans") > 0, whole).otherwise(text)
    ).drop("_secret_base", "_secret_spans")

"""Documents whose sets of word shingles have a Jaccard similarity of at least `percent` %.

Method: a prefix-filtered set join. All sets are put in one order, rare shingles first. If two sets
are similar enough, the first few shingles of one (its prefix) meet those of the other, so only
documents that share a prefix shingle are candidates; length, position and suffix filters thin them
out, and each remaining pair is verified once on the whole sets.

How it stays linear on copies:
- Documents with equal sets are one class, found by a 128-bit hash of the set. From then on only
  classes count; a task sends each class it meets once.
- All classes that share a prefix shingle are first compared with one of them, the least by hash,
  which is mostly the same for all shingles of a group of near-copies. What these stars connect
  need not be compared again: the result is the connected components. Then all remaining pairs of
  classes that share a prefix shingle and lie in different components are compared. No link between
  components is lost, and a large group of near-copies does not meet itself pair by pair.

Rarity comes from counts over all texts: every task counts the shingles of its blocks, repeated
ones are summed up, and those above 1 / `MOST_FREQUENT` of all counted are listed. That bounds the
list; the others count as equally rare and are ordered by hash. The order only decides how much
work there is, not the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from loanrisk.llm.blocks import map_groups, paired_blocks, pairs_in_groups
from loanrisk.llm.common import discard, only, release, rows_with_ids, rows_without_ids, stored, utf8_values
from loanrisk.llm.components import connected_components
from loanrisk.llm.shingles import WordHashes, shingle_set

#: The list of frequent shingles has no more entries than this (12 MB).
MOST_FREQUENT = 1_000_000
BLOCK = 2_000_000
#: Counts per set for the suffix filter, and for a first one when classes meet by shingle.
SEGMENTS, COARSE = 256, 128
#: Shingles are joined in so many parts, one after the other, which divides the disk it takes.
PARTS = 4
SEGMENT_BOUNDS = np.array([(k << 64) // SEGMENTS for k in range(1, SEGMENTS)], dtype=np.uint64)
ROWS = 200_000


def _least_common(size: int, percent: int) -> int:
    """How many shingles a set must share with any set it is similar to."""
    return -(-percent * size // 100)


def _class_of(shingles: np.ndarray) -> tuple[int, int]:
    key = xxhash.xxh3_128_intdigest(shingles.tobytes())
    return (key >> 64) - 2**63, (key & (2**64 - 1)) - 2**63


def _repeated(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    tokens, counts = np.unique(np.concatenate(held), return_counts=True)
    often = counts > 1
    return tokens[often].view(np.int64), counts[often]


def _describe(n: int):
    """Per document its class and segment counts, and now and then a row of shingle counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, size, seen = WordHashes(), [], 0, set()

        def batch_of(docs: list[tuple], counted=None) -> pa.RecordBatch:
            tokens, counts = counted or ([], [])
            rows = [*docs, (None,) * 6] if counted else docs
            columns = list(zip(*rows)) if rows else [[]] * 6
            lists = [None] * len(docs) + [(tokens, counts)] * bool(counted)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)]
                + [pa.array([x and x[i] for x in lists], pa.list_(pa.int64())) for i in (0, 1)],
                names=["doc_id", "n_shingles", "c1", "c2", "segments", "coarse", "tokens", "counts"],
            )

        for batch in batches:
            docs = []
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), utf8_values(batch.column("text"))):
                s = shingle_set(data, n, hashes)
                c1, c2 = _class_of(s)
                segments = np.diff(np.searchsorted(s, SEGMENT_BOUNDS), prepend=0, append=len(s))
                coarse = segments.reshape(COARSE, -1).sum(axis=1)
                docs.append((doc_id, len(s), c1, c2, _bytes(segments), _bytes(coarse)))
                if c1 not in seen:
                    seen.add(c1)
                    held.append(s)
                    size += len(s)
                if size >= BLOCK:
                    yield batch_of([], _repeated(held))
                    held, size, seen = [], 0, set()
            yield batch_of(docs)
        if held:
            yield batch_of([], _repeated(held))

    return run


def _postings(n: int, percent: int, frequent):
    """(token, c1, size, pos) for the prefix of each class that a task has not met yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, counts = frequent.value
        hashes, seen, held, rows = WordHashes(), set(), [], 0

        def flush() -> pa.RecordBatch:
            sizes = [len(t) for t, _, _ in held]
            return pa.RecordBatch.from_arrays(
                [
                    np.concatenate([t for t, _, _ in held]).view(np.int64),
                    np.repeat(np.array([c for _, c, _ in held], dtype=np.int64), sizes),
                    np.repeat(np.array([k for _, _, k in held], dtype=np.int32), sizes),
                    np.concatenate([np.arange(k, dtype=np.int32) for k in sizes]),
                ],
                names=["token", "c1", "size", "pos"],
            )

        for batch in batches:
            for data in utf8_values(batch.column("text")):
                s = shingle_set(data, n, hashes)
                c1, _ = _class_of(s)
                if not len(s) or c1 in seen:
                    continue
                if len(seen) >= BLOCK:
                    seen.clear()
                seen.add(c1)
                at = np.searchsorted(tokens, s)
                at[at == len(tokens)] = 0
                count = np.where(tokens[at] == s, counts[at], 0) if len(tokens) else np.zeros(len(s))
                prefix = len(s) - _least_common(len(s), percent) + 1
                held.append((s[np.lexsort((s, count))[:prefix]], c1, len(s)))
                rows += prefix
                if rows >= ROWS:
                    yield flush()
                    held, rows = [], 0
        if held:
            yield flush()

    return run


def _similar(n: int, percent: int):
    """(a, b): of rows with the texts of two documents those that are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            kept, last, y = [], None, None
            sides = zip(utf8_values(batch.column("x_text")), utf8_values(batch.column("y_text")), batch.column("y_rep").to_pylist())
            for x_text, y_text, y_rep in sides:
                if y_rep != last:  # rows with one y are neighbours
                    last, y = y_rep, shingle_set(y_text, n, hashes)
                x = shingle_set(x_text, n, hashes)
                common = len(np.intersect1d(x, y, assume_unique=True))
                kept.append(100 * common >= percent * (len(x) + len(y) - common))
            kept = pa.array(kept, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("x_rep").filter(kept), batch.column("y_rep").filter(kept)], names=["a", "b"]
            )

    return run


def _frequent(described: DataFrame):
    """Sorted shingles and their counts, as a broadcast; at most `MOST_FREQUENT` of them."""
    counted = (
        described.where("tokens is not null")
        .select(F.explode(F.arrays_zip("tokens", "counts")).alias("t"))
        .groupBy(F.col("t.tokens").alias("token"))
        .agg(F.sum("t.counts").alias("n"))
    )
    counted = stored(counted, "counts")
    total = counted.agg(F.sum("n")).first()[0] or 0
    # No more than MOST_FREQUENT shingles can each have over 1 / MOST_FREQUENT of the total.
    listed = counted.where(F.col("n") > F.lit(total / MOST_FREQUENT)).toArrow()
    tokens = np.array(listed.column("token"), dtype=np.int64).view(np.uint64)
    order = np.argsort(tokens)
    counts = np.minimum(np.array(listed.column("n"), dtype=np.int64), 2**31 - 1).astype(np.int32)
    return described.sparkSession.sparkContext.broadcast((tokens[order], counts[order]))


def _ceil_div(a: Column, b: int) -> Column:
    return F.ceil(a / F.lit(b))


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The suffix filter: shingles are counted in segments of the hash range, and sets whose counts
    differ by so much in total have at least so many shingles that are not shared."""
    return np.abs(x.astype(np.int16) - y).sum(axis=1, dtype=np.int64)


def _bytes(counts: np.ndarray) -> bytes:
    """Counts as bytes; larger ones become 255, which keeps differences bounds from below."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def _counts(segments, number: int = SEGMENTS) -> np.ndarray:
    return np.frombuffer(b"".join(segments), dtype=np.uint8).reshape(-1, number)


@F.pandas_udf(LongType())
def _segments_apart(x: pd.Series, y: pd.Series) -> pd.Series:
    return pd.Series(_apart(_counts(x), _counts(y)))


def _verified(
    pairs: DataFrame, docs: DataFrame, classes: DataFrame, n: int, percent: int
) -> DataFrame:
    """(a, b): the document ids of the pairs (c1 of either) that are similar, each checked once."""

    def side(p: str) -> DataFrame:
        size = F.col("n_shingles").cast("long").alias(f"{p}_n_shingles")
        return classes.select(size, *[F.col(c).alias(f"{p}_{c}") for c in ("c1", "c2", "rep", "segments")])

    shared = _ceil_div(percent * (F.col("x_n_shingles") + F.col("y_n_shingles")), 100 + percent)
    close = (
        pairs.join(side("x"), F.col("x") == F.col("x_c1"))
        .join(side("y"), F.col("y") == F.col("y_c1"))
        .where(
            (100 * F.col("x_n_shingles") >= percent * F.col("y_n_shingles"))
            & (100 * F.col("y_n_shingles") >= percent * F.col("x_n_shingles"))
        )
        .where(
            _segments_apart("x_segments", "y_segments")
            <= F.col("x_n_shingles") + F.col("y_n_shingles") - 2 * shared
        )
        .select("x_rep", "y_rep")
    )
    close = stored(close, "pairs")

    def with_text(df: DataFrame, p: str) -> DataFrame:
        """Add the text of one side. Texts are smaller than sets, and are not stored."""
        own = rows_with_ids(docs, close.select(f"{p}_rep")).select(
            F.col("doc_id").alias("own_id"), F.col("text").alias(f"{p}_text")
        )
        return df.join(own, F.col(f"{p}_rep") == F.col("own_id")).drop("own_id")

    texts = with_text(with_text(close.select("x_rep", "y_rep"), "x"), "y")
    return texts.select("x_rep", "x_text", "y_rep", "y_text").mapInArrow(_similar(n, percent), "a long, b long")


def _pairs(rows: DataFrame, a: str, b: str) -> DataFrame:
    return rows.select(F.least(a, b).alias("x"), F.greatest(a, b).alias("y")).where("x != y").distinct()


def near_copies(
    docs: DataFrame,
    n: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: `doc_id`, `n_shingles`, `component_id`.

    `component_id` is the smallest id reachable over links, the own id included. Texts are read
    whole. Null and empty texts, and texts without words, have no shingles and are linked with
    nothing. Rows with a null id are returned with a null component and link nothing. Rows that
    repeat an id each get their own text's count and class. Other columns are not read; an empty
    table gives an empty result.
    """
    docs = only(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    spark = docs.sparkSession
    described = stored(
        docs.mapInArrow(
            _describe(n),
            "doc_id long, n_shingles int, c1 long, c2 long, segments binary, coarse binary,"
            " tokens array<long>, counts array<long>",
        ),
        "described",
    )
    members = described.where("c1 is not null and n_shingles > 0").drop("tokens", "counts")
    classes = stored(
        members.where("doc_id is not null")
        .groupBy("c1", "c2")
        .agg(
            F.min("doc_id").alias("rep"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("segments").alias("segments"),
            F.first("coarse").alias("coarse"),
        ),
        "classes",
    )

    frequent = _frequent(described)
    postings = stored(
        docs.select("text").mapInArrow(
            _postings(n, percent, frequent), "token long, c1 long, size int, pos int"
        ),
        "postings",
    )
    parts = []
    for part in _parts(postings):
        ends = part.groupBy("token").agg(F.min("c1").alias("low"), F.max("c1").alias("high")).where("low != high")
        parts.append(stored(part.join(ends.drop("high"), "token"), "shared"))
        release(spark)
    shared = reduce(DataFrame.unionByName, parts)
    discard(postings)

    stars = stored(_pairs(shared, "c1", "low"), "stars")
    links = stored(_verified(stars, docs, classes, n, percent), "links")
    release(spark)

    # What the stars connect is done; pairs across components are left.
    found = connected_components(links)
    labels = stored(
        classes.join(found, classes.rep == found.node, "left").select(
            "c1", "coarse", F.coalesce("component", "rep").alias("component")
        ),
        "labels",
    )
    rest = shared.select("token", "c1", "size", "pos").distinct().join(labels, "c1")
    split = (
        rest.groupBy("token")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low != high")
        .select("token")
    )
    rest = stored(rest.join(split, "token", "left_semi"), "rest")
    for part in parts:
        discard(part)
    release(spark)
    met = []
    for part in _parts(rest):
        met.append(stored(_across(part, percent), "across"))
        release(spark)
    # A pair that failed as part of a star is not verified again.
    across = reduce(DataFrame.unionByName, met).distinct().join(stars, ["x", "y"], "left_anti")
    discard(rest)
    links = stored(links.unionByName(_verified(across, docs, classes, n, percent)), "links")
    release(spark)

    # Classes alone with one member need no row: their document is its own component.
    final = connected_components(links)
    sizes = members.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("members"))
    known = stored(
        classes.join(sizes, ["c1", "c2"])
        .join(final, F.col("rep") == F.col("node"), "left")
        .where("members > 1 or component is not null")
        .select(
            F.col("c1").alias("k1"), F.col("c2").alias("k2"), F.coalesce("component", "rep").alias("component")
        ),
        "known",
    )
    return (
        described.where("c1 is not null")
        .join(known, (F.col("c1") == F.col("k1")) & (F.col("c2") == F.col("k2")), "left")
        .select(
            "doc_id",
            F.col("n_shingles").cast("long").alias("n_shingles"),
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        )
    )


def _parts(rows: DataFrame) -> list[DataFrame]:
    return [rows.where(F.pmod("token", F.lit(PARTS)) == k) for k in range(PARTS)]


def _across(rest: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes in different components that share a prefix shingle and pass the filters."""

    def compare(rows: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        c1, component, block, other, size, pos = (
            rows.column(c).to_numpy().astype(np.int64) for c in ("c1", "component", "block", "other", "size", "pos")
        )
        segments = _counts(rows.column("coarse").to_pylist(), COARSE)
        needs_index = -(-2 * percent * size // (100 + percent))
        in_index = pos <= size - needs_index  # the shorter set of a pair needs a shorter prefix
        for i, j in pairs_in_groups(starts, block, other):
            ok = (component[i] != component[j]) & (
                100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j])
            )
            ok &= ((size[i] <= size[j]) & in_index[i]) | ((size[j] <= size[i]) & in_index[j])
            # Position filter: what follows the first shared shingle bounds the overlap.
            needed = -(-percent * (size[i] + size[j]) // (100 + percent))
            ok &= np.minimum(size[i] - pos[i], size[j] - pos[j]) >= needed
            i, j, needed = i[ok], j[ok], needed[ok]
            close = np.empty(len(i), dtype=bool)
            for k in range(0, len(i), ROWS // 4):
                part = slice(k, k + ROWS // 4)
                most = size[i[part]] + size[j[part]] - 2 * needed[part]
                close[part] = _apart(segments[i[part]], segments[j[part]]) <= most
            if close.any():
                yield pa.RecordBatch.from_pydict({"l": c1[i[close]], "r": c1[j[close]]})

    dealt = paired_blocks(rest, ["token"], "c1")
    return _pairs(map_groups(dealt, ["token"], compare, "l long, r long"), "l", "r")


def drop_near_copies(
    docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The input rows without those of a component whose smallest id is another one.

    Rows without an id, and unlinked ones, all stay.
    """
    found = near_copies(docs, n, percent, id_col, text_col)
    gone = found.where("component_id != doc_id").select("doc_id")
    return rows_without_ids(docs, gone, id_col)

"""Repeated runs of lines: of a passage that occurs several times the first occurrence stays.

Method: prefix doubling over the sequences of line identifiers. Level k names the block of 2**k
lines that begins at each position by the first position at which it begins; level k + 1 is made
from the pairs of names 2**k lines apart. Positions whose block occurs once are dropped at every
level, so the tables shrink quickly. The positions with one name are an interval of the suffix
array, with a common prefix of at least 2**k lines; a run of any length between is identified by
the names of the two blocks that cover its beginning and its end.

A repeated run counts if it has at least `min_words` words. Such a run is the union of the shortest
runs with that many words that begin, or end, at its lines; these have `min_words` lines at most,
so the number of levels is fixed, whatever the length of a document. Every shortest run that
occurred before is deleted, which deletes exactly the later copies of all maximal repeated runs.

Names stand for the sorted ranks of a suffix array: both say which positions share a block, but a
name takes a minimum per group instead of a global sort.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanrisk.llm.common import only, stored, utf8_values

MIN_WORDS = 50
ROWS = 100_000
#: Stands for a null id inside, so that keys can be compared; it sorts first.
NO_ID = -(2**63)


def _lines(min_words: int):
    """Every line with words: (doc_id, text_hash, line, place, h1, h2, ahead, back).

    `line` counts all lines, `place` those with words. `ahead` and `back` are the lengths in places
    of the shortest run with `min_words` words that begins or ends here; 0 if there is none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text_hash", "line", "place", "h1", "h2", "ahead", "back"]
        kinds = [pa.int64()] * 2 + [pa.int32()] * 2 + [pa.int64()] * 2 + [pa.int32()] * 2
        held: list[list] = [[] for _ in names]

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(held, kinds)], names=names)
            for column in held:
                column.clear()
            return out

        for batch in batches:
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), utf8_values(batch.column("text"))):
                lines = data.split(b"\n")
                words = np.array([len(x.split()) for x in lines])
                there = np.flatnonzero(words)
                if not len(there):
                    continue
                ends = np.cumsum(words[there])
                begins = ends - words[there]
                last = np.searchsorted(ends, begins + min_words)  # the place where the run is long enough
                ahead = np.where(last < len(there), last - np.arange(len(there)) + 1, 0)
                first = np.searchsorted(begins, ends - min_words, side="right") - 1
                back = np.where(ends >= min_words, np.arange(len(there)) - first + 1, 0)
                keys = [xxhash.xxh3_128_intdigest(lines[k].strip()) for k in there.tolist()]
                text_hash = xxhash.xxh3_64_intdigest(data) - 2**63
                for column, values in zip(
                    held,
                    (
                        [doc_id] * len(there),
                        [text_hash] * len(there),
                        there.tolist(),
                        range(len(there)),
                        [(k >> 64) - 2**63 for k in keys],
                        [(k & (2**64 - 1)) - 2**63 for k in keys],
                        ahead.tolist(),
                        back.tolist(),
                    ),
                ):
                    column.extend(values)
                if len(held[0]) >= ROWS:
                    yield flush()
        if held[0]:
            yield flush()

    return run


DOC = ["doc_id", "text_hash"]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = only(docs, doc_id=id_col, text=text_col)
    return rows.withColumn("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)))


def _position(place: str | Column = "place") -> Column:
    return F.struct(*DOC, F.col(place).alias("place") if isinstance(place, str) else place.alias("place"))


def _named(rows: DataFrame, key: list[str]) -> DataFrame:
    """Add `name`, the first position with the same key, and keep keys that occur more than once."""
    groups = (
        rows.groupBy(*key)
        .agg(F.min(_position()).alias("name"), F.max(_position()).alias("_last"))
        .where("name != _last")
        .drop("_last")
    )
    groups = groups.select(*[F.col(k).alias(f"_{k}") for k in key], "name")
    return rows.join(groups, [F.col(k) == F.col(f"_{k}") for k in key]).drop(*[f"_{k}" for k in key])


def repeated_lines(
    docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, text_hash, lines): the line numbers to delete, of documents that have any.

    Lines end at line feeds and are compared without white space at their ends; lines without
    words are passed over. "Before" is by id (null first), then hash of the text, then line. Rows
    with the same id and text are one document. Texts are read whole.
    """
    rows = _keyed(docs, id_col, text_col)
    schema = (
        "doc_id long, text_hash long, line int, place int, h1 long, h2 long, ahead int, back int"
    )
    lines = stored(rows.mapInArrow(_lines(min_words), schema), "lines")
    level = _named(lines, ["h1", "h2"]).dropDuplicates([*DOC, "place"])
    level = stored(level.select(*DOC, "place", "line", "ahead", "back", "name"), "level")
    first = level
    runs = stored(
        first.where("ahead > 0")
        .select(*DOC, "place", F.col("ahead").alias("size"))
        .unionByName(first.where("back > 0").select(*DOC, (F.col("place") - F.col("back") + 1).alias("place"), F.col("back").alias("size")))
        .distinct(),
        "runs",
    )
    gone = []
    size = 1
    while size <= min_words:
        here = runs.where(F.col("size").between(size, 2 * size - 1))
        at = level.select(*DOC, "place", "name")
        tails = at.select(*DOC, F.col("place").alias("end"), F.col("name").alias("tail"))
        known = (
            here.withColumn("end", F.col("place") + F.col("size") - size)
            .join(at, [*DOC, "place"])
            .join(tails, [*DOC, "end"])
        )
        repeated = _named(known.select(*DOC, "place", "size", F.col("name").alias("head"), "tail"), ["size", "head", "tail"])
        gone.append(stored(repeated.where(_position() != F.col("name")).select(*DOC, "place", "size"), "gone"))
        # The next level: blocks of twice the size, from two names `size` places apart.
        ahead = Window.partitionBy(*DOC).orderBy("place").rangeBetween(size, size)
        pairs = at.withColumn("next", F.first("name").over(ahead)).where("next is not null")
        pairs = pairs.withColumnRenamed("name", "head")
        level = stored(_named(pairs, ["head", "next"]).select(*DOC, "place", "name"), "level")
        size *= 2
        if level.isEmpty():
            break
    deleted = gone[0]
    for more in gone[1:]:
        deleted = deleted.unionByName(more)
    places = deleted.select(*DOC, F.explode(F.sequence("place", F.col("place") + F.col("size") - 1)).alias("place")).distinct()
    return (
        places.join(first.select(*DOC, "place", "line"), [*DOC, "place"])
        .groupBy(*DOC)
        .agg(F.sort_array(F.collect_list("line")).alias("lines"))
    )


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, counts = [], []
        for data, gone in zip(utf8_values(batch.column("text")), batch.column("lines").to_pylist()):
            lines = data.split(b"\n")
            counts.append(len(lines) if data else 0)
            if gone:
                gone = set(gone)
                data = b"\n".join(x for k, x in enumerate(lines) if k not in gone)
            texts.append(data.decode())
        removed = [len(gone or ()) for gone in batch.column("lines").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())],
            names=["doc_id", "n_lines", "n_removed", "text"],
        )


def drop_repeated_lines(
    docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: `doc_id`, `n_lines`, `n_removed` and the `text` that is left.

    See `repeated_lines` for what is deleted. Null and empty texts give an empty text of no lines.
    Null ids and repeated rows are kept (rows with the same id and text lose the same lines). Other
    columns are not read; an empty table gives an empty result.
    """
    gone = stored(repeated_lines(docs, min_words, id_col, text_col), "repeated").select(
        F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"), "lines"
    )
    hashed = _keyed(docs, id_col, text_col).mapInArrow(_hashed, "doc_id long, text string, text_hash long")
    # The same plan at every size: whole texts move once, to the lines that go from them.
    joined = hashed.join(
        gone.hint("merge"), (F.col("doc_id") == F.col("gone_id")) & (F.col("text_hash") == F.col("gone_hash")), "left"
    )
    cleaned = joined.select("doc_id", "text", "lines").mapInArrow(
        _without, "doc_id long, n_lines long, n_removed long, text string"
    )
    return cleaned.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes = [xxhash.xxh3_64_intdigest(d) - 2**63 for d in utf8_values(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hashes, pa.int64())], names=["doc_id", "text", "text_hash"])

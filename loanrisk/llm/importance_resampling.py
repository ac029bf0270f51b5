"""Importance resampling towards a target distribution, over hashed word n-grams.

Method: a document is scanned once. Its words, one separator before each, are one string, of which
the running CRC-32 is kept at every word's begin and end. The CRC-32 of any n-gram follows from the
two kept values at its ends: shifting the first by the n-gram's length, a linear map over GF(2), and
adding the second cancels all that stands before. Shifts are table look-ups, so all n-grams of a batch
come from a few array operations. The buckets are written, two bytes a feature; corpus counts and
scores read them and never the texts again.

A feature's gain is the logarithm of how much commoner its bucket is in the target than in the
documents, a document's weight the mean gain. Documents are drawn without replacement by adding
Gumbel noise from a hash of the id and taking the highest scores; ranks come from a range partitioning
by score and the row counts of its partitions.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanrisk.llm.ascii_words import words
from loanrisk.llm.common import only, partitions_for, stored, utf8_values

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = "2024"
#: Words of texts that are hashed at a time.
WORDS = 1_000_000
#: Shifts by fewer bytes have a table each; longer ones are made of these and of powers of two.
SHORT = 64

# The CRC-32 of one byte (reflected polynomial 0xEDB88320), and the step it takes.
_BYTE = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _BYTE = np.where(_BYTE & 1, (_BYTE >> 1) ^ np.uint32(0xEDB88320), _BYTE >> 1).astype(np.uint32)


def _zero_byte(state: np.ndarray) -> np.ndarray:
    return (state >> np.uint32(8)) ^ _BYTE[state & np.uint32(255)]


def _tables(images: np.ndarray) -> np.ndarray:
    """A linear map as four tables of 256, from the images of the 32 single bits."""
    tables = np.zeros((4, 256), dtype=np.uint32)
    for byte in range(4):
        for bit in range(8):
            tables[byte, 1 << bit : 2 << bit] = tables[byte, : 1 << bit] ^ images[8 * byte + bit]
    return tables


def _apply(tables: np.ndarray, state: np.ndarray) -> np.ndarray:
    out = tables[0][state & np.uint32(255)]
    for byte in range(1, 4):
        out = out ^ tables[byte][(state >> np.uint32(8 * byte)) & np.uint32(255)]
    return out


def _shifts() -> tuple[np.ndarray, list[np.ndarray]]:
    """Shifts by 0 to SHORT - 1 bytes, and by SHORT * 2 ** j bytes."""
    images, short = np.uint32(1) << np.arange(32, dtype=np.uint32), []
    for _ in range(SHORT):
        short.append(_tables(images))
        images = _zero_byte(images)
    long = []
    for _ in range(32):
        long.append(_tables(images))
        images = _apply(long[-1], images)
    return np.stack(short), long


_SHORT, _LONG = _shifts()


def shifted(state: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC values moved past `size` further bytes."""
    few = size % SHORT
    out = _SHORT[few, 0, state & np.uint32(255)]
    for byte in range(1, 4):
        out = out ^ _SHORT[few, byte, (state >> np.uint32(8 * byte)) & np.uint32(255)]
    many = size // SHORT
    for j in range(int(many.max()).bit_length() if len(many) else 0):
        far = (many >> j & 1).astype(bool)
        out[far] = _apply(_LONG[j], out[far])
    return out


def _next(crc: int, word: bytes) -> int:
    return zlib.crc32(word, zlib.crc32(b" ", crc))


class Hashes:
    """CRC-32 of the n-grams of some documents, given as lists of words."""

    def __init__(self, documents: list[list[bytes]]):
        self.sizes = np.array([len(d) for d in documents], dtype=np.int64)
        ends = [list(itertools.accumulate(d, _next, initial=0)) for d in documents]
        kept = np.fromiter(itertools.chain.from_iterable(ends), dtype=np.uint32)
        first = np.zeros(len(kept), dtype=bool)  # the value before a document's first word
        first[np.cumsum(self.sizes + 1) - self.sizes - 1] = True
        last = np.zeros(len(kept), dtype=bool)
        last[np.cumsum(self.sizes + 1) - 1] = True
        self.at_end = kept[~first]
        before = ~kept[~last]  # one step of a separator, on the register itself
        self.at_begin = ~(_BYTE[(before ^ np.uint32(32)) & np.uint32(255)] ^ (before >> np.uint32(8)))
        lengths = np.fromiter((len(w) for d in documents for w in d), dtype=np.int64, count=int(self.sizes.sum()))
        self.end = np.cumsum(lengths + 1)
        self.begin = self.end - lengths
        self.rest = np.repeat(np.cumsum(self.sizes), self.sizes) - np.arange(len(lengths))  # words to the document's end

    def ngrams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """CRC-32 of all runs of n words joined by one space, and each run's first word."""
        first = np.flatnonzero(self.rest >= n)
        last = first + n - 1
        size = self.end[last] - self.begin[first]
        return shifted(self.at_begin[first], size) ^ self.at_end[last], first


def hashed_features(
    docs: DataFrame, least: int, most: int, buckets: int, id_col: str | None, text_col: str
) -> DataFrame:
    """(doc_id, n_words, features): the buckets of all n-grams of each text, as little-endian unsigned
    integers of `bucket_type`, in no set order. Without `id_col` the ids are null."""
    kind = bucket_type(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(ids: list, documents: list[list[bytes]]) -> pa.RecordBatch:
            hashes = Hashes(documents)
            found = [hashes.ngrams(n) for n in range(least, most + 1)]
            values = np.concatenate([crc % np.uint32(buckets) for crc, _ in found]).astype(kind)
            owner = np.repeat(np.arange(len(documents)), hashes.sizes)
            owners = np.concatenate([owner[first] for _, first in found])
            if len(found) > 1:
                values = values[np.argsort(owners, kind="stable")]
            ends = np.cumsum(np.bincount(owners, minlength=len(documents))).tolist()
            data = values.tobytes()
            width = kind.itemsize
            features = [data[a * width : b * width] for a, b in zip([0, *ends], ends)]
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(hashes.sizes), pa.array(features, pa.binary())],
                names=["doc_id", "n_words", "features"],
            )

        for batch in batches:
            ids, documents, size = [], [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), utf8_values(batch.column("text"))):
                ids.append(doc_id)
                documents.append(words(text))
                size += len(documents[-1])
                if size >= WORDS:
                    yield batch_of(ids, documents)
                    ids, documents, size = [], [], 0
            if ids:
                yield batch_of(ids, documents)

    if id_col is None:
        named = docs.select(F.lit(None).cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    else:
        named = only(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return named.mapInArrow(run, "doc_id long, n_words long, features binary")


def bucket_type(buckets: int) -> np.dtype:
    return np.dtype("<u2" if buckets <= 1 << 16 else "<u4")


def _all_features(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all rows of a batch, and how many each row has."""
    parts = column.to_pylist()
    return np.frombuffer(b"".join(parts), kind), np.array([len(p) for p in parts], dtype=np.int64) // kind.itemsize


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """How many features of all rows fall into each bucket; a task adds up its own first."""
    kind = bucket_type(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            counts += np.bincount(_all_features(batch.column("features"), kind)[0], minlength=buckets)
        there = np.flatnonzero(counts)
        if len(there):
            yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(counts[there])], names=["bucket", "n"])

    total = np.zeros(buckets, dtype=np.int64)
    summed = features.select("features").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for row in summed.collect():  # a row per bucket
        total[row["bucket"]] = row["n"]
    return total


def bucket_gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + m) / ((s + 1)(T + m)))) of every bucket, for m buckets."""
    m, whole, wanted = len(documents), int(documents.sum()), int(target.sum())
    ratio = [
        (t + 1) * (whole + m) / ((s + 1) * (wanted + m)) for s, t in zip(documents.tolist(), target.tolist())
    ]
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], dtype=np.int64)


def resample(
    docs: DataFrame,
    target: DataFrame,
    least: int = 1,
    most: int = 1,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: str = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank): one row per document.

    Features are all runs of `least` to `most` words. `weight` is the floored mean of the features'
    gains (0 without features), `score` adds floor(-1000 ln(-ln((h + 0.5) / 2^32))) for the first 32
    bits h of sha256(`seed:doc_id`). Of the N documents with at least `least_words` words the
    floor(percent * N / 100) of the highest score are drawn, ties by smaller id; `rank` numbers them
    from 1 and is null for the others.

    Null and empty texts hold no words. A null id is hashed as an empty one and comes last in ties;
    repeated rows are documents of their own. Other columns are not read; empty tables count as no
    features, and without documents the result is empty.
    """
    kind = bucket_type(buckets)
    features = stored(
        hashed_features(docs, least, most, buckets, id_col, text_col).withColumn("_row", F.monotonically_increasing_id()),
        "features",
    )
    wanted = bucket_counts(hashed_features(target, least, most, buckets, None, target_text_col), buckets)
    gains = features.sparkSession.sparkContext.broadcast(bucket_gains(bucket_counts(features, buckets), wanted))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, sizes = _all_features(batch.column("features"), kind)
            sums = np.append(0, np.cumsum(gains.value[found]))
            ends = np.cumsum(sizes)
            weight = np.where(sizes > 0, (sums[ends] - sums[ends - sizes]) // np.maximum(sizes, 1), 0)
            columns = [batch.column(c) for c in ("doc_id", "n_words", "_row")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sizes), pa.array(weight)], names=["doc_id", "n_words", "_row", "n_features", "weight"]
            )

    weighed = features.mapInArrow(weigh, "doc_id long, n_words long, _row long, n_features long, weight long")
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = weighed.withColumn("score", F.col("weight") + noise).withColumn("_able", F.col("n_words") >= least_words)

    # Sorted over all partitions, documents that can be drawn first; a row's number is its place.
    order = [F.col("_able").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_row")]
    ordered = scored.repartitionByRange(partitions_for(docs), *order).sortWithinPartitions(*order)
    ordered = stored(ordered.withColumn("_place", F.monotonically_increasing_id()), "scores")
    part = F.shiftright("_place", 33)
    # One row per partition.
    parts = ordered.groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("_able")).alias("able")
    )
    before, able, bounds = 0, 0, []
    for row in sorted(parts.collect()):
        bounds.append((row["part"], before))
        before += row["n"]
        able += row["able"]
    starts = docs.sparkSession.createDataFrame(bounds, "_part long, _before long")
    place = F.col("_before") + F.col("_place").bitwiseAND((1 << 33) - 1) + 1
    ranked = ordered.join(F.broadcast(starts), part == F.col("_part"))
    return ranked.select(
        "doc_id",
        "n_words",
        "n_features",
        "weight",
        "score",
        F.when(F.col("_able") & (place <= percent * able // 100), place).alias("rank"),
    )

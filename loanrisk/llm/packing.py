"""Packing of token pieces into as few sequences of at most `capacity` tokens as it can.

Method: exact complements, then best fit. What decides is how many pieces there are of each
length, a table of at most `capacity` rows, so planning costs the same for any number of documents.
The longest available piece opens a sequence. Its gap is filled exactly if a single length, a pair
or a triple sums up to it (looked up in an index of available lengths and of pair sums, under the
remaining counts); otherwise the longest fitting piece goes in and the new gap is tried. A found
combination is used as often as the counts allow, so the plan has about as many steps as there are
lengths.

The pieces themselves stay on the executors. A piece's number among those of its length is its
number within the task that wrote it plus those of the tasks before; the plan, a small table, maps length and
number to a sequence and a place. Only lengths are sorted for that; the pieces meet their places in one
shuffle and are not sorted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanrisk.llm.common import only, stored
from loanrisk.llm.word_tokens import END_ID, VOCABULARY, worker_tokens

CAPACITY = 4096


def token_pieces(
    docs: DataFrame,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
) -> DataFrame:
    """(doc_id, piece, start, length, ids): every document's ids and end id, cut at `capacity`.

    Null and empty texts are one piece that holds the end id alone. Null ids and repeated rows are
    kept; other columns are not read; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = worker_tokens(vocabulary)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            doc, piece, start, ids = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(doc, pa.int64()),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(sizes := np.array([len(x) for x in ids], dtype=np.int64)),
                    pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)),
                        pa.array(np.concatenate(ids).astype(np.int32)),
                    ),
                ],
                names=["doc_id", "piece", "start", "length", "ids"],
            )

        for batch in batches:
            rows, size = [], 0
            texts = (text.as_py() for text in batch.column("text"))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tokens.documents(texts, end_id)):
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    rows.append((doc_id, piece, start, ids[start : start + capacity]))
                size += len(ids)
                if size > 500_000:
                    yield batch_of(rows)
                    rows, size = [], 0
            if rows:
                yield batch_of(rows)

    named = only(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return named.mapInArrow(run, "doc_id long, piece int, start long, length long, ids array<int>")


class Plan:
    """Which lengths share a sequence: rows (length, first, count, each, sequence, offset).

    Pieces `first` to `first + count * each - 1` of a length go to `count` sequences from
    `sequence` on, `each` per sequence, the first of them at `offset`.
    """

    def __init__(self, counts: np.ndarray, capacity: int):
        self.capacity, self.left = capacity, counts.astype(np.int64).copy()
        self.used = np.zeros_like(self.left)
        self.rows: list[tuple] = []
        self.sequences = 0
        self._index_pairs()
        top = capacity
        while True:
            while top > 0 and not self.left[top]:
                top -= 1
            if not top:
                break
            self._place(self._fill(top))

    def _place(self, lengths: list[int]) -> None:
        sizes, each = np.unique(lengths, return_counts=True)
        count = int((self.left[sizes] // each).min())
        offset = 0
        for size, times in zip(sizes.tolist()[::-1], each.tolist()[::-1]):
            self.rows.append((size, int(self.used[size]), count, times, self.sequences, offset))
            self.used[size] += count * times
            self.left[size] -= count * times
            offset += size * times
        self.sequences += count

    def _fill(self, first: int) -> list[int]:
        """The lengths of one sequence that starts with `first`."""
        inside, gap = [first], self.capacity - first
        self.left[first] -= 1
        while gap:
            exact = self._single(gap) or self._pair(gap) or self._triple(gap)
            if not exact:
                fitting = np.flatnonzero(self.left[1 : gap + 1])
                if not len(fitting):
                    break
                exact = [int(fitting[-1]) + 1]
            for size in exact:
                self.left[size] -= 1
            inside += exact
            gap -= sum(exact)
        for size in inside:
            self.left[size] += 1
        return inside

    def _single(self, gap: int) -> list[int]:
        return [gap] if self.left[gap] else []

    def _pair(self, gap: int) -> list[int]:
        """Two available lengths that sum to `gap`, the smaller one as small as it can be."""
        low = np.arange(1, gap // 2 + 1)
        if not len(low):
            return []
        high = gap - low
        ok = (self.left[low] > 0) & (self.left[high] > 0) & ((low != high) | (self.left[low] > 1))
        k = int(ok.argmax())
        return [int(high[k]), int(low[k])] if ok[k] else []

    def _triple(self, gap: int) -> list[int]:
        """Three available lengths that sum to `gap`, found by an index of the pair sums.

        Counts only fall, so an old index misses no pair; it may name pairs that are used up. After
        some of these it is made anew.
        """
        fresh = False
        while True:
            high = np.arange(gap, 0, -1)
            likely = high[(self.left[high] > 0) & self._pair_sums[gap - high]]
            for tried, x in enumerate(likely.tolist()):
                if tried == 32 and not fresh:
                    break
                self.left[x] -= 1
                pair = self._pair(gap - x)
                self.left[x] += 1
                if pair:
                    return [x, *pair]
            else:
                return []
            self._index_pairs()
            fresh = True

    def _index_pairs(self) -> None:
        there = (self.left > 0).astype(np.float64)
        spectrum = np.fft.rfft(there, 2 * len(there))
        self._pair_sums = np.fft.irfft(spectrum * spectrum, 2 * len(there)) > 0.5


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The rows of `pieces` with `sequence_id` and `offset` added; needs a `length` column.

    Lengths must lie in 1 to `capacity`; any other, and null, raises. Offsets are gapless from 0
    within a sequence. All other columns are carried (they are stored once in the shared folder);
    columns named `sequence_id` or `offset` are replaced, names starting with `_pack_` are reserved.
    An empty table gives an empty result.
    """

    length = F.col("length").cast("long")
    fits = length.isNotNull() & length.between(1, capacity)
    message = F.concat(F.lit(f"lengths must lie in 1 to {capacity}: "), F.coalesce(length.cast("string"), F.lit("null")))
    carried = pieces.drop("sequence_id", "offset").withColumn(
        "length", F.when(fits, length).otherwise(F.raise_error(message).cast("long"))
    )
    columns = carried.columns
    # The number of a row: its task, and its place within the task.
    numbered = stored(carried.withColumn("_pack_row", F.monotonically_increasing_id()), "pieces")
    numbered = numbered.withColumn("_pack_task", F.shiftright("_pack_row", 33))

    per_task = numbered.groupBy("length", "_pack_task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("_pack_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(
        per_task.withColumn("_pack_before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"), "offsets"
    )
    # At most one row per length.
    totals = numbered.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in totals:
        counts[row["length"]] = row["n"]
    names = ["length", "first", "count", "each", "sequence", "offset"]
    plan = pd.DataFrame(Plan(counts, capacity).rows, columns=names, dtype="int64")
    shared = pieces.sparkSession.sparkContext.broadcast(
        {size: rows.sort_values("first").to_numpy() for size, rows in plan.groupby("length")}
    )

    # A third of all pieces may have one length; by task they are in parts, so no group is large.
    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        at = np.zeros((len(length), 2), dtype=np.int64)
        for size, rows in length.groupby(length):
            steps, numbers = shared.value[size], number[rows.index].to_numpy()
            step = steps[np.searchsorted(steps[:, 1], numbers, side="right") - 1]
            inside = numbers - step[:, 1]
            where = length.index.get_indexer(rows.index)
            at[where, 0] = step[:, 4] + inside // step[:, 3]
            at[where, 1] = step[:, 5] + inside % step[:, 3] * size
        return pd.DataFrame({"sequence_id": at[:, 0], "offset": at[:, 1]})

    within = F.row_number().over(Window.partitionBy("length", "_pack_task").orderBy("_pack_row")) - 1
    # Numbers are found without the other columns, such as the ids of the pieces; then rows meet their
    # places one to one, and stream past them unsorted.
    places = (
        numbered.select("length", "_pack_task", "_pack_row")
        .withColumn("_pack_number", within)
        .join(offsets, ["length", "_pack_task"])
        .select("_pack_row", place("length", F.col("_pack_number") + F.col("_pack_before")).alias("_pack_at"))
    )
    return numbered.join(places.hint("shuffle_hash"), "_pack_row").select(
        *[F.col(f"`{c}`") for c in columns], "_pack_at.sequence_id", "_pack_at.offset"
    )


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of every sequence, from packed pieces that carry `ids`."""
    inside = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(inside, lambda p: p["ids"])).alias("ids"))

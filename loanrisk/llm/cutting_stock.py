"""Packing of documents into sequences of at most `capacity` tokens with next to no padding.

Method: cutting stock by column generation. A document is cut into whole sequences and a rest that
is shorter. How many rests there are of each length, a table of fewer than `capacity` rows, decides;
planning costs the same for any number of documents. A linear program chooses how often to use
which pattern (a multiset of lengths that share a sequence), at the cost of the pattern's padded
length: a sequence is padded to `capacity` unless its length is a power of two. Knapsack dynamic
programming over the dual prices finds the patterns that the program lacks, until none lowers the
cost or the padding left is below `GAP`. Patterns without padding are used as often as the
rounded-down solution says. The few rests left over are laid end to end and cut where a sequence is
full; the last tokens are cut at powers of two. So no sequence is padded.

Documents stay on the executors. A piece's rank among those of its length is its number within its
task plus those of the tasks before; the plan leads from length and rank to sequence and place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanrisk.llm.byte_tokens import VOCABULARY, worker_tokens
from loanrisk.llm.common import only, stored

CAPACITY = 1024
END_ID = 0
#: Padding, as a share of all tokens, that the linear program may leave to the rounding.
GAP = 1e-6
MOST_ROUNDS = 300
REFRESH = 400
LEANING = 0.5
TRIED = 64
#: A pattern must save so much of a sequence to enter.
LEAST_GAIN = 1e-7
IDS = 500_000


def powers_of_two(capacity: int) -> list[int]:
    return [1 << k for k in range(capacity.bit_length()) if 1 << k <= capacity]


class Patterns:
    """The linear program: counts of patterns that hold each length as often as it is there.

    `columns` are the basic patterns, one per length (how often it holds each), `uses` how often
    each is used. Revised simplex method with an explicit inverse of the basis.
    """

    def __init__(self, lengths: np.ndarray, demand: np.ndarray, capacity: int):
        self.lengths, self.demand, self.capacity = lengths, demand.astype(np.float64), capacity
        self.free = set(powers_of_two(capacity))
        self._start()
        self.costs = np.array([self.cost(int(t)) for t in self.columns @ lengths], dtype=np.float64)
        self.inverse = np.linalg.inv(self.columns.T.astype(np.float64))
        total = float(lengths @ self.demand)
        pivots, lean = 0, LEANING
        for _ in range(MOST_ROUNDS if len(lengths) else 0):
            self.prices = self.costs @ self.inverse
            # Prices swing from round to round. Without padding every length is worth itself, so
            # patterns are sought at prices that lean to the lengths.
            entered = sum([self._enter(x) for x in self._good_patterns(lean * lengths + (1 - lean) * self.prices)])
            pivots += entered
            if self.costs @ self.uses <= total * (1 + GAP) or not entered and not lean:
                break
            lean = LEANING if entered else lean / 2 if lean > 0.1 else 0
            if pivots >= REFRESH:  # against the growth of rounding errors
                self.inverse = np.linalg.inv(self.columns.T.astype(np.float64))
                self.uses = np.maximum(self.inverse @ self.demand, 0)
                pivots = 0

    def _start(self) -> None:
        """First patterns: the longest length that is left, with others that fill the gap. Each is
        used until a length runs out, and is that length's basic pattern."""
        n = len(self.lengths)
        at = np.full(self.capacity + 1, -1)
        at[self.lengths] = np.arange(n)
        left = self.demand.copy()
        self.columns = np.diag(self.capacity // self.lengths).astype(np.int64)
        self.uses = np.zeros(n)
        while len(there := np.flatnonzero(left > 0)):
            pattern = np.zeros(n, dtype=np.int64)
            pattern[there[-1]] = 1
            gap = self.capacity - int(self.lengths[there[-1]])
            while gap and len(there := there[self.lengths[there] <= gap]):
                other = at[gap - self.lengths[there]]  # makes an exact pair, if there is such a length
                exact = (other >= 0) & (left[other] > 0)
                if left[at[gap]] > 0 and at[gap] >= 0:
                    more = [at[gap]]
                elif exact.any():
                    k = int(exact.argmax())
                    more = [there[k], other[k]]
                else:
                    more = [there[-1]]
                np.add.at(pattern, more, 1)
                gap -= int(self.lengths[more].sum())
            inside = np.flatnonzero(pattern)
            ratios = left[inside] / pattern[inside]
            out = inside[int(ratios.argmin())]
            self.columns[out], self.uses[out] = pattern, ratios.min()
            left[inside] -= pattern[inside] * ratios.min()
            left[out] = 0

    def cost(self, length: int) -> int:
        return length if length in self.free else self.capacity

    def _good_patterns(self, prices: np.ndarray) -> list[np.ndarray]:
        """Patterns that lower the cost at the given prices, the best first: a knapsack for every
        total length; for a full sequence the best one that holds each length."""
        best = np.full(self.capacity + 1, -np.inf)
        best[0] = 0
        last = np.zeros(self.capacity + 1, dtype=np.int64)
        fitting = np.searchsorted(self.lengths, np.arange(self.capacity + 1), side="right").tolist()
        for total in range(1, self.capacity + 1):
            if n := fitting[total]:
                worth = best[total - self.lengths[:n]] + prices[:n]
                k = int(worth.argmax())
                best[total], last[total] = worth[k], k

        gains = {(total, -1): best[total] - total for total in self.free if total < self.capacity}
        whole = best[self.capacity - self.lengths] + prices - self.capacity
        gains |= {(self.capacity - int(s), k): whole[k] for k, s in enumerate(self.lengths)}
        if not np.isfinite(best[self.capacity]):  # no full sequence can be made
            top = int(best.argmax())
            gains[top, -1] = best[top] - self.cost(top)
        wanted = sorted((g, key) for key, g in gains.items() if g > LEAST_GAIN * self.capacity)[::-1]
        found: dict[bytes, np.ndarray] = {}
        for _, (total, first) in wanted[:TRIED]:
            pattern = np.zeros(len(self.lengths), dtype=np.int64)
            if first >= 0:
                pattern[first] = 1
            while total:
                pattern[last[total]] += 1
                total -= int(self.lengths[last[total]])
            found.setdefault(pattern.tobytes(), pattern)
        return list(found.values())

    def _enter(self, pattern: np.ndarray) -> bool:
        """If it still lowers the cost, the pattern takes the place of the basic one that runs out
        first."""
        inside = np.flatnonzero(pattern)
        cost = self.cost(int(pattern @ self.lengths))
        gain = float(self.prices[inside] @ pattern[inside]) - cost
        if gain <= LEAST_GAIN * self.capacity:
            return False
        step = self.inverse[:, inside] @ pattern[inside]
        able = step > 1e-7
        ratios = np.full(len(step), np.inf)
        ratios[able] = self.uses[able] / step[able]
        # Of those that run out together, the one with the largest pivot.
        out = int(np.where(ratios <= ratios.min() * (1 + 1e-9) + 1e-12, step, 0).argmax())
        self.uses = np.maximum(self.uses - ratios[out] * step, 0)
        self.uses[out] = ratios[out]
        row = self.inverse[out] / step[out]
        rows, columns = np.flatnonzero(step), np.flatnonzero(row)
        self.inverse[np.ix_(rows, columns)] -= np.outer(step[rows], row[columns])
        self.inverse[out] = row
        self.prices = self.prices - gain * row
        self.columns[out] = pattern
        self.costs[out] = cost
        return True


#: A run of ranks goes `each` to a sequence, from `offset` of `sequence` on; or, where `each` is 0,
#: end to end from position `offset` of the stream of the rest.
PLAN_COLUMNS = ["length", "first", "count", "each", "sequence", "offset"]


class Plan:
    """Where the pieces of each length go: `counts[length]`, up to `capacity`.

    `rows` (see `PLAN_COLUMNS`) are as many as the lengths in all patterns. What full patterns leave
    over is a stream of tokens, cut at `bounds`: into full sequences, and the last tokens at powers
    of two. The stream's sequences are numbered from `sequences` on.
    """

    def __init__(self, counts: np.ndarray, capacity: int):
        rows: list[tuple] = []
        self.capacity, self.sequences = capacity, 0
        left = counts.astype(np.int64).copy()
        used = np.zeros_like(left)

        def use(parts: list[tuple[int, int]], times: int) -> None:
            offset = 0
            for length, each in parts:
                rows.append((length, int(used[length]), times * each, each, self.sequences, offset))
                used[length] += times * each
                left[length] -= times * each
                offset += length * each
            self.sequences += times

        if left[capacity]:
            use([(capacity, 1)], int(left[capacity]))
        lengths = np.flatnonzero(left)
        program = Patterns(lengths, left[lengths], capacity)
        for k in np.argsort(-program.uses, kind="stable").tolist():
            pattern = program.columns[k]
            inside = np.flatnonzero(pattern)
            held = int(pattern @ lengths)
            times = min(int(program.uses[k] + 1e-6), int((left[lengths[inside]] // pattern[inside]).min()))
            if times and program.cost(held) == held:  # a pattern that needs padding goes to the rest
                use(list(zip(lengths[inside].tolist(), pattern[inside].tolist()))[::-1], times)
        at = 0
        for length in np.flatnonzero(left)[::-1].tolist():
            rows.append((length, int(used[length]), int(left[length]), 0, 0, at))
            at += length * int(left[length])
        self.stream = at
        self.rows = pd.DataFrame(rows, columns=PLAN_COLUMNS, dtype="int64")
        self.tails = np.cumsum([0] + [p for p in powers_of_two(capacity)[::-1] if at % capacity & p])

    def stream_place(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sequence, offset and remaining room at positions of the stream."""
        full = self.stream // self.capacity
        sequence, offset = np.divmod(at, self.capacity)
        room = self.capacity - offset
        tail = sequence >= full
        inside = at[tail] - full * self.capacity
        part = np.searchsorted(self.tails, inside, side="right") - 1
        sequence[tail] = full + part
        offset[tail] = inside - self.tails[part]
        room[tail] = self.tails[np.minimum(part + 1, len(self.tails) - 1)] - inside
        return sequence + self.sequences, offset, room

    def places(self, length: np.ndarray, rank: np.ndarray) -> pd.DataFrame:
        """(row, skip, size, sequence_id, offset): the parts of pieces, by their place in the input."""
        if not hasattr(self, "_by_length"):
            self._by_length = {size: rows.sort_values("first").to_numpy() for size, rows in self.rows.groupby("length")}
        row, skip, size, sequence, offset = [], [], [], [], []
        for s in np.unique(length).tolist():
            where = np.flatnonzero(length == s)
            steps = self._by_length[s]
            _, first, _, each, start, base = steps[np.searchsorted(steps[:, 1], rank[where], side="right") - 1].T
            inside = rank[where] - first
            together = each > 0
            times = np.maximum(each, 1)
            row.append(where[together])
            skip.append(np.zeros(int(together.sum()), dtype=np.int64))
            size.append(np.full(int(together.sum()), s))
            sequence.append((start + inside // times)[together])
            offset.append((base + inside % times * s)[together])
            which, at = where[~together], (base + inside * s)[~together]
            done = np.zeros(len(at), dtype=np.int64)
            while len(which):
                number, begin, room = self.stream_place(at + done)
                part = np.minimum(room, s - done)
                for out, values in zip((row, skip, size, sequence, offset), (which, done, part, number, begin)):
                    out.append(values)
                more = done + part < s
                which, at, done = which[more], at[more], (done + part)[more]
        names = ["row", "skip", "size", "sequence_id", "offset"]
        return pd.DataFrame(dict(zip(names, (np.concatenate(x) for x in (row, skip, size, sequence, offset)))))


def token_rests(
    docs: DataFrame,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids, task, number): every document's ids and end id, cut
    into pieces of `capacity` ids and a shorter rest.

    `ids` are little-endian unsigned integers of the narrowest type that holds the vocabulary
    (`id_width` bytes). `task` and `number` tell the pieces of one length apart. Null and empty texts
    hold the end id alone. Null ids and repeated rows are kept; other columns are not read; an empty
    table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = worker_tokens(vocabulary)
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        names = ["doc_id", "start", "length", "doc_tokens", "ids", "task", "number"]

        def batch_of(held: list[tuple]) -> pa.RecordBatch:
            rows = []
            for doc_id, ids in held:
                for start in range(0, len(ids), capacity):
                    piece = ids[start : start + capacity]
                    size = len(piece)
                    rows.append((doc_id, start, size, len(ids), piece.tobytes(), task, int(seen[size])))
                    seen[size] += 1
            kinds = [pa.int64()] * 4 + [pa.binary(), pa.int32(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            held, size = [], 0
            texts = (text.as_py() for text in batch.column("text"))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tokens.documents(texts, end_id)):
                held.append((doc_id, ids.astype(f"<u{tokens.dtype.itemsize}")))
                size += len(ids)
                if size > IDS:
                    yield batch_of(held)
                    held, size = [], 0
            if held:
                yield batch_of(held)

    named = only(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    schema = "doc_id long, start long, length long, doc_tokens long, ids binary, task int, number long"
    return named.mapInArrow(run, schema)


def id_width(vocabulary: str = VOCABULARY) -> int:
    """Bytes of an id in `ids`."""
    return worker_tokens(vocabulary).dtype.itemsize


def pack_documents(
    docs: DataFrame,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
) -> DataFrame:
    """(doc_id, start, length, doc_tokens, sequence_id, offset, ids): one row per piece.

    `start` counts the ids of the document before the piece, `ids` is as in `token_rests`. Every id
    of every document, its end id included, lies in one piece. A sequence holds at most `capacity`
    ids and is gapless from offset 0; none needs padding, as each is full or as long as a power of
    two. Nulls, repeated rows and empty tables as in `token_rests`.

    The pieces are written once; places come from their lengths and numbers alone, and the ids move
    once, to be joined with them.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    width = id_width(vocabulary)
    pieces = stored(
        token_rests(docs, capacity, id_col, text_col, vocabulary, end_id).withColumn(
            "_row", F.monotonically_increasing_id()
        ),
        "rests",
    )
    # Counted twice, from two stored columns, rather than written: that would take a file from each task.
    per_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    earlier = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    # At most `capacity` rows.
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[row["length"]] = row["n"]
    shared = pieces.sparkSession.sparkContext.broadcast(Plan(counts, capacity))

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = shared.value.places(batch["length"].to_numpy(), batch["rank"].to_numpy())
            yield at.assign(_row=batch["_row"].to_numpy()[at["row"]])[["_row", "skip", "size", "sequence_id", "offset"]]

    # The earlier counts grow with the number of tasks, so they are joined and not broadcast.
    ranked = (
        pieces.select("_row", "length", "task", "number")
        .join(earlier.hint("merge"), ["length", "task"])
        .select("_row", "length", (F.col("number") + F.col("earlier")).alias("rank"))
        .mapInPandas(placed, "_row long, skip long, size long, sequence_id long, offset long")
    )
    return pieces.join(ranked.hint("merge"), "_row").select(
        "doc_id",
        (F.col("start") + F.col("skip")).alias("start"),
        F.col("size").alias("length"),
        "doc_tokens",
        "sequence_id",
        "offset",
        F.substring("ids", F.col("skip") * width + 1, F.col("size") * width).alias("ids"),
    )


def unpacked(ids: bytes, vocabulary: str = VOCABULARY) -> np.ndarray:
    """The token ids of a piece."""
    return np.frombuffer(ids, f"<u{id_width(vocabulary)}").astype(np.int64)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the ids of every sequence, in order."""
    inside = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(inside, F.lit(b""), lambda all_, p: F.concat(all_, p["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))

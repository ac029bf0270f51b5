"""Comparing all rows that share a key, with bounded memory per task whatever the key's share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanrisk.llm.common import partitions_for, stored

#: A key with more rows is cut into blocks, and every pair of blocks is compared by itself.
MOST_ROWS = 2_000


def paired_blocks(rows: DataFrame, keys: list[str], spread: str, most: int = MOST_ROWS) -> DataFrame:
    """Deal rows out so that all rows of a key meet, in groups of at most about two blocks.

    Adds `block`, `other` and `group` and sorts: rows with equal `group` are neighbours in one
    partition. A key of up to `most` rows is one group with block 0. A larger key has blocks, by the
    hash of `spread`, and a group for every two blocks and for each one; its rows come once for each
    group they are in, with the group's `other` block. Two rows are to be compared in a group of one
    block, whose rows have `other` equal to `block`, or if their blocks differ. Rows that are equal in
    `spread` cannot be told apart, so it should be unique within a key.
    """
    counts = stored(
        rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most), "hot_keys"
    ).select(*[F.col(k).alias(f"_{k}") for k in keys], F.ceil(F.col("_n") / most).cast("int").alias("_blocks"))
    matches = [F.col(k) == F.col(f"_{k}") for k in keys]
    dealt = rows.join(counts, matches, "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
    own = F.pmod(F.xxhash64(spread), F.col("_blocks")).cast("int")
    dealt = dealt.withColumn("block", own).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    )
    low, high = F.least("block", "_other"), F.greatest("block", "_other")
    group = F.xxhash64(*keys, low, high)
    return (
        dealt.withColumn("group", group)
        .withColumnRenamed("_other", "other")
        .drop("_blocks", *[f"_{k}" for k in keys])
        .repartition(partitions_for(rows), "group")
        .sortWithinPartitions("group", *keys)
    )


def map_groups(
    dealt: DataFrame,
    keys: list[str],
    compare: Callable[[pa.Table, np.ndarray], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """Call `compare(rows, starts)` with whole groups of `paired_blocks`: `starts` has the first row
    of each group and the number of rows. Small groups come many at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            first, end = _ends(batch)
            if last is not None and first != end and sum(b.num_rows for b in waiting) >= 20_000:
                # The last group may go on in this batch; what lies before is complete.
                ready, rest = _split(pa.Table.from_batches([*waiting, batch]))
                yield from compare(ready, _starts(ready))
                waiting = rest.to_batches()
            else:
                waiting.append(batch)
            last = end
        if waiting:
            table = pa.Table.from_batches(waiting)
            yield from compare(table, _starts(table))

    def _ends(batch: pa.RecordBatch) -> tuple:
        at = lambda i: tuple(batch.column(k)[i].as_py() for k in ("group", *keys))
        return at(0), at(batch.num_rows - 1)

    def _starts(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, dtype=bool)
        new[0] = True
        for k in ("group", *keys):
            values = table.column(k).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        return np.append(np.flatnonzero(new), table.num_rows)

    def _split(table: pa.Table) -> tuple[pa.Table, pa.Table]:
        at = int(_starts(table)[-2])
        return table.slice(0, at), table.slice(at)

    return dealt.mapInArrow(run, schema)


def pairs_in_groups(starts: np.ndarray, block: np.ndarray, other: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The row pairs to be compared, as index arrays: first all neighbours, then those two apart, ..."""
    sizes = np.diff(starts)
    group = np.repeat(np.arange(len(sizes)), sizes)
    # A group of two blocks compares across them only, also if one of them has no rows.
    within = block == other
    left = np.arange(len(group))
    for apart in range(1, int(sizes.max())):
        left = left[left + apart < len(group)]
        left = left[group[left] == group[left + apart]]
        right = left + apart
        wanted = within[left] | (block[left] != block[right])
        yield left[wanted], right[wanted]

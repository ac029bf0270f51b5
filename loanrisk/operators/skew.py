"""Equi-joins that stay balanced when single keys hold a large share of the rows.

A shuffle join sends all rows of a key to one task. Here the few hot keys are split into slices:
every row of the large side picks a slice from its own `spread` column, and the matching rows of
the other side are repeated once per slice. Both sides then join on (key, slice). Nothing is
dropped and no row is matched twice.

The list of hot keys holds every key with more than `slice_rows` rows and more than one in
`max_hot_keys` of all rows. Fewer than `max_hot_keys` keys can be that large, whatever the data
size, so the list is safe to broadcast; the rest are joined as usual.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanrisk.config import SkewConfig

SLICE = "_slice"
SLICES = "_slices"


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per key that is not null: columns `key`, `row_count`.

    One aggregation with map-side partial counts, which reads the key column only. Stored beside a
    table, the counts spare later joins that scan (see `hot_counted`).
    """
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))


def hot_counted(counts: DataFrame, key: str, config: SkewConfig = SkewConfig()) -> DataFrame:
    """The large keys among `key_counts` and the number of slices for each: columns `key`, `_slices`.

    Both sides of a join must see the same list, so `counts` must give the same rows whenever it is
    read.
    """
    share = counts.agg(F.sum("row_count") / F.lit(config.max_hot_keys)).scalar()
    large = F.col("row_count") > F.greatest(F.lit(float(config.slice_rows)), share)
    return counts.where(large).select(key, F.ceil(F.col("row_count") / config.slice_rows).cast("int").alias(SLICES))


def hot_keys(df: DataFrame, key: str, config: SkewConfig = SkewConfig()) -> DataFrame:
    """The large keys of `df`, counted in place; the exchange of the counts also serves the total."""
    return hot_counted(key_counts(df, key), key, config)


def scatter(
    df: DataFrame, hot: DataFrame, key: str, spread: str, config: SkewConfig = SkewConfig()
) -> DataFrame:
    """Add the slice of each row of the large side; rows of ordinary keys all get slice 0.

    The slice comes from the content of `spread`, which should differ between the rows of a key,
    so a recomputed task gives every row the same slice again. Rows without a key match nothing
    and are spread freely.
    """
    slices = F.when(F.col(key).isNull(), F.lit(config.keyless_slices)).otherwise(
        F.coalesce(F.col(SLICES), F.lit(1))
    )
    return (
        df.join(F.broadcast(hot), key, "left")
        .withColumn(SLICE, F.pmod(F.xxhash64(spread), slices).cast("int"))
        .drop(SLICES)
    )


def repeat_per_slice(df: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """Repeat each row of the other side once per slice of its key."""
    last = F.coalesce(F.col(SLICES), F.lit(1)) - 1
    return (
        df.join(F.broadcast(hot), key, "left")
        .withColumn(SLICE, F.explode(F.sequence(F.lit(0), last)))
        .drop(SLICES)
    )

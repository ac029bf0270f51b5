"""Incremental load: the rows of a batch that a table does not hold yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanrisk.config import SkewConfig
from loanrisk.operators.skew import hot_keys


def new_rows(
    existing: DataFrame, batch: DataFrame, key: str = "id", config: SkewConfig = SkewConfig()
) -> DataFrame:
    """Rows of `batch` whose key is not in `existing`; rows with a null key always pass.

    Copies inside the batch all pass together. Only rows with an ordinary key are shuffled: rows
    without a key match nothing, and for the few hot keys (a bounded list, see `skew`) it is
    enough to look up whether the key is known. The known keys are first narrowed to those of the
    batch; where Spark finds the batch small enough to broadcast, the table is only scanned.
    """
    arriving = batch.select(key).where(F.col(key).isNotNull()).distinct()
    known = existing.select(key).distinct().join(arriving, key, "left_semi")
    hot = hot_keys(batch, key, config).select(key)
    # The list is short, mostly empty: the table is looked through for it alone, and only if it has keys.
    stored_hot = existing.select(key).join(F.broadcast(hot), key, "left_semi").distinct()
    hot_known = hot.join(stored_hot.withColumn("_known", F.lit(True)), key, "left").select(
        key, F.coalesce("_known", F.lit(False)).alias("_known")
    )
    marked = batch.join(F.broadcast(hot_known), key, "left")
    # _known is null for ordinary and missing keys.
    looked_up = marked.where(F.col(key).isNull() | (F.col("_known") == F.lit(False)))
    compared = marked.where(F.col(key).isNotNull() & F.col("_known").isNull()).join(
        known, key, "left_anti"
    )
    return looked_up.unionByName(compared).select(*batch.columns)


def append_new_loans(
    existing: DataFrame, batch: DataFrame, key: str = "id", config: SkewConfig = SkewConfig()
) -> DataFrame:
    """The table after the load: everything it held plus the new rows of the batch."""
    return existing.unionByName(new_rows(existing, batch, key, config))

"""Row versions with validity dates (slowly changing dimension, type 2).

A version is valid on [effective_date, end_date); the current one ends at 9999-12-31.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN_END = date(9999, 12, 31)
VERSION_COLUMNS = ("effective_date", "end_date", "is_current")


def _load_day(load_date: date | None) -> Column:
    return F.current_date() if load_date is None else F.lit(load_date)


def scd2_initial(df: DataFrame, load_date: date | None = None) -> DataFrame:
    """Mark every row as the current version from `load_date` (default: today) on."""
    return df.withColumns(
        {
            "effective_date": _load_day(load_date),
            "end_date": F.lit(OPEN_END),
            "is_current": F.lit(True),
        }
    )


def scd2_merge(
    dim: DataFrame,
    incoming: DataFrame,
    key: str,
    tracked: Sequence[str],
    load_date: date | None = None,
) -> DataFrame:
    """The dimension after a load.

    `incoming` holds one row per natural `key`, with the dimension's attribute columns. A key whose
    `tracked` attributes differ (null-safe) gets its current version closed on `load_date` and a
    new one opened; a new key gets its first version; a key that is missing or unchanged keeps its
    version as it is. A change on the day a version was opened replaces that version. Loading the
    same rows twice changes nothing. The load fails when it is older than a current version, when a
    key is missing or comes twice (see `dedup_by_key`), or when `is_current` is null in a row.

    Only current versions take part in the join, one per key on both sides, so long histories add
    no skew: they pass through untouched. So do current versions without a key, which nothing
    matches; a missing incoming key is found before rows are moved.
    """
    attributes = [c for c in dim.columns if c not in VERSION_COLUMNS]
    day = _load_day(load_date)

    def version(source: str, start: Column, end: Column, current: bool) -> Column:
        return F.struct(
            *[F.col(f"{source}.{c}").alias(c) for c in attributes],
            start.alias("effective_date"),
            end.alias("end_date"),
            F.lit(current).alias("is_current"),
        )

    copies = Window.partitionBy("_new_key").orderBy(F.lit(0))
    no_key = F.raise_error(F.lit("scd2_merge: an incoming key is missing")).cast("boolean")
    keyed = incoming.where(F.when(F.col(key).isNull(), no_key).otherwise(True))
    new = keyed.select(F.col(key).alias("_new_key"), F.struct(*attributes).alias("_new"))
    new = new.withColumn("_copy", F.row_number().over(copies))
    unknown = F.raise_error(F.lit("scd2_merge: is_current is null")).cast("boolean")
    current = F.coalesce(F.col("is_current"), unknown)
    keyless = F.col(key).isNull()
    old = dim.where(F.when(current, ~keyless).otherwise(False)).select(F.col(key).alias("_old_key"), F.struct(*dim.columns).alias("_old"))

    has_old, has_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    checks = {
        "the load is older than a current version": F.col("_old.effective_date") > day,
        "an incoming key comes twice": F.col("_copy") > 1,
    }
    passes = F.lit(True)
    for message, fails in checks.items():
        error = F.raise_error(F.lit(f"scd2_merge: {message}")).cast("boolean")
        passes = F.when(fails, error).otherwise(passes)

    same = F.lit(True)
    for name in tracked:
        same = same & F.col(f"_old.{name}").eqNullSafe(F.col(f"_new.{name}"))

    kept = version("_old", F.col("_old.effective_date"), F.col("_old.end_date"), True)
    ended = version("_old", F.col("_old.effective_date"), day, False)
    opened = version("_new", day, F.lit(OPEN_END), True)
    versions = (
        F.when(~has_old, F.array(opened))
        .when(has_new & ~same & (F.col("_old.effective_date") == day), F.array(opened))
        .when(has_new & ~same, F.array(ended, opened))
        .otherwise(F.array(kept))
    )
    merged = (
        old.join(new, F.col("_old_key") == F.col("_new_key"), "full_outer")
        .where(passes)
        .select(F.explode(versions).alias("_v"))
        .select("_v.*")
    )
    older = F.raise_error(F.lit("scd2_merge: the load is older than a current version")).cast("boolean")
    waits = F.when(keyless & (F.col("effective_date") > day), older).otherwise(keyless)
    return dim.where(F.when(current, waits).otherwise(True)).unionByName(merged)

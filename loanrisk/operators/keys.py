"""Surrogate keys and deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The borrower attributes inside the member key, in hashing order.
MEMBER_ATTRIBUTES = [
    "emp_title",
    "emp_length",
    "home_ownership",
    "annual_inc",
    "zip_code",
    "addr_state",
    "grade",
    "sub_grade",
    "verification_status",
]
KEY_SEPARATOR = "||"
KEY_NULL = "__NULL__"


def hashed_key(columns: Sequence[str]) -> Column:
    """SHA-256 (hex) over the text of the columns, nulls included.

    The cast to string is explicit because ANSI mode refuses to mix a number with the null marker.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(KEY_NULL)) for c in columns]
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *parts), 256)


def add_member_id(df: DataFrame) -> DataFrame:
    """Replace `member_id` with the key derived from the borrower attributes."""
    return df.withColumn("member_id", hashed_key(MEMBER_ATTRIBUTES))


#: Bytes of a packed key; other texts are packed behind so many zeros and one more, so none is as long.
HASH_BYTES = 32


def packed_key(name: str) -> Column:
    """A text key for an exchange: SHA-256 in hex as its bytes, half as long; any other text as it is,
    behind zeros. Different texts stay different and null stays null; keys of one kind keep their order.
    """
    text, value = F.col(name), F.unhex(name)
    is_hash = (F.length(text) == 2 * HASH_BYTES) & (F.lower(F.hex(value)) == text)
    return F.when(is_hash, value).otherwise(F.concat(F.lit(bytes(HASH_BYTES + 1)), text.cast("binary")))


def unpacked_key(name: str) -> Column:
    """The text that `packed_key` has packed."""
    value = F.col(name)
    rest = F.substring(value, HASH_BYTES + 2, 2**31 - 1).cast("string")
    return F.when(F.length(value) == HASH_BYTES, F.lower(F.hex(value))).otherwise(rest)


def dedup_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order_column: str,
    ascending: bool = False,
    tie_breakers: Sequence[str] = (),
) -> DataFrame:
    """Keep one row per key: the first by `order_column` (nulls last when descending).

    Ties fall to `tie_breakers` and then to every other column, so rows that still tie are
    identical and the result is the same on every run, retry and partitioning.

    The shape `row_number() == 1` lets Spark keep one row per key in each map task before the
    shuffle, so a key that holds a third of the table sends at most one row per task.
    """
    order = F.col(order_column)
    named = {*keys, order_column, *tie_breakers}
    rest = [c for c in df.columns if c not in named]
    window = Window.partitionBy(*keys).orderBy(
        order.asc() if ascending else order.desc(),
        *[F.col(c).asc() for c in (*tie_breakers, *rest)],
    )
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")

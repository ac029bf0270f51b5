"""Exact duplicates by content-defined chunks.

Every text is cut where a rolling hash of its last 32 bytes says so, in one pass that keeps the
text where it is read. What travels is the recipe: the ordered list of chunk identifiers (8 bytes
for about 2 KB of text). Identifiers are verified: wherever two chunks share an identifier but not
their SHA-256, all texts that hold this identifier also compare their lists of SHA-256 (normally
there is none, and no text is looked up). Texts are equal exactly when their recipes are, and recipes
are grouped with a partial count per task, so a text with a third of all rows costs one row per task.
Members meet their group by recipe and slice: a group with more rows than the mean partition is
repeated once per slice of that many, so no task gets all of its members.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanrisk.config import SkewConfig
from loanrisk.llm.common import BROADCAST_IDS, only, partitions_for, rows_without_ids, stored, utf8_values
from loanrisk.operators.skew import SLICE, SLICES, repeat_per_slice, scatter

WINDOW = 32
SHORTEST, MEAN_BITS, LONGEST = 512, 11, 16_384
BLOCK = 1 << 21
GEAR = np.random.Generator(np.random.PCG64(20)).integers(0, 2**32, 256, dtype=np.uint32)


def cut_points(data: bytes, mean_bits: int = MEAN_BITS) -> np.ndarray:
    """The places (exclusive ends) where the hash of the last 32 bytes ends in zeros."""
    raw = np.frombuffer(data, dtype=np.uint8)
    found = []
    for begin in range(0, len(raw), BLOCK):
        first = max(0, begin - WINDOW + 1)
        h = GEAR[raw[first : begin + BLOCK]]
        width = 1
        while width < WINDOW:  # h[i] comes to cover the last 2 * width bytes
            shifted = h[:-width] << np.uint32(width)
            h[width:] += shifted
            width *= 2
        hits = np.flatnonzero((h >> np.uint32(32 - mean_bits)) == 0) + first + 1
        found.append(hits[hits > begin])
    return np.concatenate(found) if found else np.empty(0, dtype=np.int64)


def chunks(data: bytes) -> list[bytes]:
    """The text in chunks of `SHORTEST` to `LONGEST` bytes (the last may be shorter); no text: none."""
    if len(data) <= SHORTEST:
        return [data] if data else []
    cuts = cut_points(data).tolist()
    out, at = [], 0
    while at < len(data):
        k = bisect_left(cuts, at + SHORTEST)
        end = min(at + LONGEST, cuts[k] if k < len(cuts) else len(data), len(data))
        out.append(data[at:end])
        at = end
    return out


def _recipes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, proofs, digests = [], [], []
        for data in utf8_values(batch.column("text")):
            parts = chunks(data)
            ids.append([xxhash.xxh3_64_intdigest(c) - 2**63 for c in parts])
            proofs.append([hashlib.sha256(c).digest() for c in parts])
            digests.append(hashlib.sha256(data).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                batch.column("doc_id"),
                pa.array(digests, pa.string()),
                pa.array(ids, pa.list_(pa.int64())),
                pa.array(proofs, pa.list_(pa.binary())),
            ],
            names=["row", "doc_id", "text_sha256", "recipe", "proofs"],
        )


def chunk_recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, text_sha256, recipe, proof): one per input row, stored.

    `recipe` is the ordered list of chunk identifiers. `proof` is null unless one of them is shared
    by different chunks; then it is the ordered list of the chunks' SHA-256.
    """
    rows = only(docs, doc_id=id_col, text=text_col).select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text"
    )
    schema = "row long, doc_id long, text_sha256 string, recipe array<long>, proofs array<binary>"
    recipes = stored(rows.mapInArrow(_recipes, schema), "recipes")
    each = recipes.select("row", F.explode(F.arrays_zip("recipe", "proofs")).alias("c"))
    clashing = stored(
        each.groupBy(F.col("c.recipe").alias("chunk"))
        .agg(F.min("c.proofs").alias("least"), F.max("c.proofs").alias("most"))
        .where("least != most")
        .select("chunk"),
        "clashing",
    )
    known = clashing.count()
    if known == 0:
        return recipes.drop("proofs").withColumn("proof", F.lit(None).cast("array<binary>"))
    doubtful = (
        each.select("row", F.col("c.recipe").alias("chunk"))
        .join(F.broadcast(clashing) if known <= BROADCAST_IDS else clashing, "chunk", "left_semi")
        .select("row", F.lit(True).alias("doubtful"))
        .distinct()
    )
    return recipes.join(doubtful, "row", "left").select(
        "row", "doc_id", "text_sha256", "recipe", F.when(F.col("doubtful"), F.col("proofs")).alias("proof")
    )


#: Name of a recipe in the list of large groups. Two recipes may share one: both are sliced then.
NAME = "_recipe_name"


def _with_groups(recipes: DataFrame, groups: DataFrame) -> DataFrame:
    """Every recipe row with the `top` and `group_size` of its group; null if it is alone.

    Groups with more rows than the mean shuffle partition are met slice by slice. There are fewer of
    them than partitions, so their list is broadcast.
    """
    share = max(1, -(-recipes.count() // partitions_for(recipes)))
    name = F.xxhash64("recipe")
    large = (
        groups.where(F.col("group_size") > share)
        .groupBy(name.alias(NAME))
        .agg(F.ceil(F.max("group_size") / share).cast("int").alias(SLICES))
    )
    config = SkewConfig(slice_rows=share)
    members = scatter(recipes.withColumn(NAME, name), large, NAME, "row", config)
    repeated = repeat_per_slice(groups.withColumn(NAME, name), large, NAME).select(
        F.col("recipe").alias("r"), F.col("proof").alias("p"), F.col(SLICE).alias("s"), "top", "group_size"
    )
    same = F.col("recipe").eqNullSafe(F.col("r")) & F.col("proof").eqNullSafe(F.col("p"))
    return members.join(repeated, same & (F.col(SLICE) == F.col("s")), "left")


def exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: `doc_id`, `keep_id`, `group_size`, `kept`, `text_sha256`.

    Texts are equal when all bytes are; null counts as empty. Of equal texts the row with the
    largest id stays. Repeated rows (same id and text) count as group members, one of them is kept.
    Null ids lose against any id; a group without ids has a null `keep_id` and one kept row. Other
    columns are not read; an empty table gives an empty result.
    """
    recipes = chunk_recipes(docs, id_col, text_col)
    groups = stored(
        recipes.groupBy("recipe", "proof")
        .agg(F.max(F.struct("doc_id", "row")).alias("top"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1"),
        "groups",
    )
    member = _with_groups(recipes, groups)
    return member.select(
        "doc_id",
        F.when(F.col("top").isNull(), F.col("doc_id")).otherwise(F.col("top.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("top.row") == F.col("row"), F.lit(True)).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows without those whose text stays under another id.

    A row is told by its id: rows without an id, and ids that also hold a text that stays, are left.
    """
    verdict = exact_copies(docs, id_col, text_col)
    gone = (
        verdict.where(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.bool_or("kept").alias("stays"))
        .where(~F.col("stays"))
    )
    return rows_without_ids(docs, gone, id_col)

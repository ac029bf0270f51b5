"""Near-duplicate vectors: sign hashing in several tables, exact cosines, connected components.

Each table hashes a vector to the signs of its products with random hyperplanes. Two vectors at
angle t agree on one sign with probability 1 - t / pi, so a pair exactly at the threshold shares a
bucket of k signs with probability p = (1 - t / pi) ** k, and is missed by all of L tables with
probability (1 - p) ** L. k grows with the logarithm of the number of vectors, so buckets keep
their size, and L follows from k and the wanted recall; pairs above the threshold are missed less.

Equal vectors are one class and count with their number. All classes of a bucket are compared by
cosine in double precision, in blocks where a bucket is large. A pair is counted in the first table
in which its buckets agree, and nowhere else. What leaves a task is, per vector, a count of links
and a tree of links that connects what its pairs connect, not the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from loanrisk.llm.blocks import map_groups, paired_blocks, pairs_in_groups
from loanrisk.llm.common import only, stored
from loanrisk.llm.components import connected_components

BUCKET = 8
RECALL = 0.999
SEED = 7
CHUNK = 200_000


def tables_for(vectors: int, threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """(k, L): signs per bucket and number of tables for a count of distinct vectors."""
    k = max(4, math.ceil(math.log2(max(vectors, 1) / BUCKET)))
    same = (1 - math.acos(threshold) / math.pi) ** k
    return k, math.ceil(math.log(1 - recall) / math.log(1 - same))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(lists.flatten(), dtype=np.float64).reshape(len(lists), -1)


def _unit(v: np.ndarray) -> np.ndarray:
    """Vectors of length 1; scaled by the largest component first, whose square need not be finite."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _buckets(dimensions: int, k: int, tables: int):
    """Add the array of bucket numbers, one per table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.Generator(np.random.PCG64(SEED)).standard_normal((dimensions, k * tables))
        weights = 1 << np.arange(k, dtype=np.int64)  # k is far below 31
        for batch in batches:
            if batch.num_rows:
                signs = (_unit(_matrix(batch.column("v"))) @ planes > 0).reshape(-1, tables, k)
                numbers = (signs * weights).sum(axis=2).astype(np.int32)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, numbers.size + 1, tables, dtype=np.int32)), pa.array(numbers.ravel())
                )
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "buckets"])

    return run


def _links(threshold: float):
    """Per bucket: (node, links, other): links counted, and one neighbour that joins their tree."""

    def compare(rows: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids, copies, block, other_block, number = (
            rows.column(c).to_numpy().astype(np.int64) for c in ("node", "copies", "block", "other", "number")
        )
        v = _unit(_matrix(rows.column("v")))
        buckets = _matrix(rows.column("buckets")).astype(np.int64)
        links = np.zeros(len(ids), dtype=np.int64)
        tree = np.arange(len(ids))  # smallest row that a row's links lead to, within the group

        def root(i: int) -> int:
            while tree[i] != i:
                tree[i] = tree[tree[i]]
                i = tree[i]
            return i

        for left, right in pairs_in_groups(starts, block, other_block):
            for at in range(0, len(left), CHUNK):
                i, j = left[at : at + CHUNK], right[at : at + CHUNK]
                near = np.einsum("ij,ij->i", v[i], v[j]) >= threshold
                i, j = i[near], j[near]
                first = (buckets[i] == buckets[j]).argmax(axis=1) == number[i]
                i, j = i[first], j[first]
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                for a, b in zip(i.tolist(), j.tolist()):
                    a, b = root(a), root(b)
                    if a != b:
                        tree[max(a, b)] = min(a, b)
        linked = np.flatnonzero(links)
        if len(linked):
            other = ids[[root(i) for i in linked.tolist()]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[linked]), pa.array(links[linked]), pa.array(other)],
                names=["node", "links", "other"],
            )

    return compare


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.95,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    recall: float = RECALL,
) -> DataFrame:
    """One row per input row: `vec_id`, `n_links`, `component_id`, `kept`.

    `n_links` counts the other rows with a cosine of at least `threshold`, `component_id` is the
    smallest id reachable over links, `kept` tells whether it is the row's own. A pair is found with
    at least the probability `recall`; no pair below the threshold is linked. Vectors that are null,
    empty or zero, or hold nulls, NaN or infinities, link with nothing and are their own component;
    so do rows without an id, whose component is null and which are kept. Rows that repeat an id
    count as vectors of their own, whatever the others of that id are linked with. All vectors must have one length; another raises. Other columns
    are not read; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    # Single precision travels as such; cosines are taken in double precision either way.
    kind = "float" if vectors.schema[vector_col].dataType == ArrayType(FloatType()) else "double"
    rows = only(vectors, vec_id=id_col, v=vector_col).select(
        F.col("vec_id").cast("long"), F.col("v").cast(f"array<{kind}>").alias("v")
    )
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))
    sound = F.col("v").isNotNull() & F.forall("v", finite) & F.exists("v", lambda x: x != 0)
    classes = (
        rows.where(sound & F.col("vec_id").isNotNull())
        .groupBy("v")
        .agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"))
    )
    # An id may stand for several vectors, so a class is known by a number of its own.
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    stats = classes.agg(F.count(F.lit(1)), F.min(F.size("v")), F.max(F.size("v"))).first()
    if stats[1] != stats[2]:
        raise ValueError(f"vectors have {stats[1]} to {stats[2]} components")
    k, tables = tables_for(stats[0], threshold, recall)
    schema = f"node long, copies long, v array<{kind}>, buckets array<int>"
    hashed = classes.select("node", "copies", "v").mapInArrow(_buckets(stats[1] or 1, k, tables), schema)
    placed = hashed.select("*", F.posexplode("buckets").alias("number", "bucket"))
    dealt = paired_blocks(placed, ["number", "bucket"], "node")
    found = stored(
        map_groups(dealt, ["number", "bucket"], _links(threshold), "node long, links long, other long"), "links"
    )
    trees = connected_components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    trees = trees.select(F.col("node").alias("_node"), F.col("component").alias("tree"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    linked = stored(
        classes.join(links, "node", "left")
        .join(trees, F.col("node") == F.col("_node"), "left")
        .where("copies > 1 or links is not null")
        .select("v", "vec_id", "copies", "links", F.coalesce("tree", "node").alias("tree")),
        "linked",
    )
    least = linked.groupBy(F.col("tree").alias("_tree")).agg(F.min("vec_id").alias("component"))
    per_class = stored(
        linked.join(least, F.col("tree") == F.col("_tree")).select(
            F.col("v").alias("w"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"), "component"
        ),
        "classes",
    )
    usable = F.when(sound & F.col("vec_id").isNotNull(), F.col("v"))
    joined = rows.select("vec_id", usable.alias("v")).join(per_class, F.col("v") == F.col("w"), "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return joined.select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )

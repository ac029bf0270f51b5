"""Connected components of an edge table, without collecting edges or components anywhere.

Rounds of large-star and small-star: every node links its larger neighbours, then its smaller
ones, to the smallest node it sees. Both are a minimum per node (partially aggregated before the
shuffle) and a join, so a node with a third of all edges is no special case: the join side that
holds it is one row per node and Spark can split the other side. The number of rounds grows with
the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanrisk.llm.common import stored

MAX_ROUNDS = 200


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable over `edges`, for every node on an edge.

    Null ends and loops are ignored; repeated edges and either direction are fine. An empty edge
    table gives an empty result.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    pairs = (
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(high.alias("u"), low.alias("v"))
        .distinct()
    )
    pairs = stored(pairs, "edges")  # every edge points to its smaller end
    state = _fingerprint(pairs)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        pairs = stored(_small_star(_large_star(pairs)), "edges")
        before, state = state, _fingerprint(pairs)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    # Settled: every edge runs from a node to the root of its star.
    nodes = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)


def _fingerprint(pairs: DataFrame) -> tuple:
    """Two equal fingerprints mean that a round changed nothing."""
    hashed = F.xxhash64("u", "v")
    row = pairs.agg(
        F.count(F.lit(1)), F.sum(hashed.cast("decimal(38,0)")), F.bit_xor(hashed)
    ).first()
    return tuple(row)


def _large_star(pairs: DataFrame) -> DataFrame:
    """Each node points its larger neighbours to the smallest node it sees, itself included."""
    smallest = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "n")
    # The larger neighbours of n are the u of the edges (u, n); without smaller ones n is its own.
    return (
        pairs.join(smallest, pairs.v == smallest.n, "left")
        .select("u", F.coalesce("m", "v").alias("v"))
        .distinct()
    )


def _small_star(pairs: DataFrame) -> DataFrame:
    """Each node points its smaller neighbours, and itself, to the smallest of them."""
    smallest = pairs.groupBy("u").agg(F.min("v").alias("m"))
    moved = (
        pairs.join(smallest, "u")
        .where(F.col("v") != F.col("m"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    return moved.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct()

"""Small tables with awkward rows, and brute-force comparisons."""

from __future__ import annotations

CLASHING = "row int, ids int, _id int, block int, token int, component_id int, length int, start int, key int, score double"


def documents(spark, rows):
    """(doc_id, text) rows with further columns whose names operators use inside."""
    padding = (1, 2, 3, 4, 5, 6, 7, 8, 9, 0.5)
    return spark.createDataFrame([(*r, *padding) for r in rows], f"doc_id long, text string, {CLASHING}")


def components(nodes, links):
    """Node to smallest node it is connected with."""
    top = {n: n for n in nodes}

    def root(n):
        while top[n] != n:
            n = top[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        top[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}

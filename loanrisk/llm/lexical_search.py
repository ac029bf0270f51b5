"""Ranked lexical search: the best documents for each query, by a sum of term impacts.

Method: documents are indexed in blocks; a block has a posting list per query term, in order of
document, and over the impacts of its postings a sparse table that answers range-maximum queries.
A query starts with one interval, the whole block. The sum of its terms' range maxima bounds the
score of every document in an interval. Intervals are taken best bound first; each is split at the
document that holds its largest impact, which is scored exactly, and the two intervals beside it get
bounds of their own. Intervals whose bound is below the score of the `k`-th best document so far are
dropped unread. A task carries the best documents from block to block, so later blocks prune more.

Queries are taken in groups of at most `QUERY_BYTES` of text, whose terms and weights travel to the
tasks; documents are read once per group. The index of a group is written, so its counts and the
search read the same rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from loanrisk.llm.ascii_words import words
from loanrisk.llm.common import only, stored, utf8_values

BLOCK_DOCS = 4096
BLOCK_WORDS = 2_000_000
QUERY_BYTES = 8_000_000
WAVE = 256
#: Best documents of tasks meet in so many parts per query before they meet at all.
PARTS = 64

INDEX = "doc_ids array<long>, sizes array<int>, terms array<int>, held array<int>, places array<int>, counts array<int>"


def _index(vocabulary: dict[bytes, int]):
    """Blocks of documents: ids and numbers of terms, and postings by term and place in the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: list[int | None] = []
        sizes: list[int] = []
        codes: list[np.ndarray] = []
        total = 0

        def block() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(codes), return_counts=True)
            terms, held = np.unique(keys // BLOCK_DOCS, return_counts=True)
            values = [docs, sizes, terms, held, keys % BLOCK_DOCS, counts]
            kinds = [pa.int64()] + [pa.int32()] * 5
            columns = [pa.array([v], pa.list_(kind)) for v, kind in zip(values, kinds)]
            return pa.RecordBatch.from_arrays(columns, names=["doc_ids", "sizes", "terms", "held", "places", "counts"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), utf8_values(batch.column("text"))):
                found = words(text)
                known = np.fromiter(filter(None, map(vocabulary.get, found)), dtype=np.int64)
                codes.append(known * BLOCK_DOCS + len(docs))
                docs.append(doc_id)
                sizes.append(len(found))
                total += len(found)
                if len(docs) == BLOCK_DOCS or total >= BLOCK_WORDS:
                    yield block()
                    docs, sizes, codes, total = [], [], [], 0
        if docs:
            yield block()

    return run


class Block:
    """Postings of one block with their impacts, and range maxima over them."""

    def __init__(self, terms: np.ndarray, held: np.ndarray, places: np.ndarray, impacts: np.ndarray):
        self.terms, self.places, self.impacts = terms, places, impacts
        self.ends = np.cumsum(held)
        self.starts = self.ends - held
        self.keys = np.repeat(np.arange(len(terms), dtype=np.int64), held) * BLOCK_DOCS + places
        # Level j, position i: where the largest impact of positions i to i + 2 ** j - 1 stands.
        # Ranges that reach into the next list are never asked for.
        levels = [np.arange(len(places), dtype=np.int32)]
        while 2 ** len(levels) <= (held.max() if len(held) else 0):
            last, half = levels[-1], 2 ** (len(levels) - 1)
            right = np.concatenate([last[half:], last[len(last) - half :]])
            levels.append(np.where(impacts[last] >= impacts[right], last, right))
        self.best = np.stack(levels) if len(places) else np.empty((1, 0), dtype=np.int32)

    def largest(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest impacts of positions low to high - 1 (0 if there are none) and where they stand."""
        size = high - low
        level = np.frexp(np.maximum(size, 1))[1] - 1
        low, some = np.where(size > 0, low, 0), size > 0
        left = self.best[level, low]
        right = self.best[level, np.where(some, high - (1 << level), 0)]
        at = np.where(self.impacts[left] >= self.impacts[right], left, right)
        return np.where(some, self.impacts[at], 0), at

    def search(self, terms: np.ndarray, top: "Top", doc_ids: np.ndarray, known: np.ndarray) -> int:
        """Offer to `top` every document that can enter it; returns how many were scored."""
        # A term that the block lacks is sorted to the place of another one, which may be the query's too.
        row = np.searchsorted(self.terms, terms)
        inside = row < len(self.terms)
        row, terms = row[inside], terms[inside]
        row = row[self.terms[row] == terms]
        if not len(row):
            return 0
        base = row[:, None] * BLOCK_DOCS
        low, high = self.starts[row][:, None], self.ends[row][:, None]
        scored = 0

        def bounded(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
            impact, at = self.largest(low, high)
            split = at[impact.argmax(axis=0), np.arange(low.shape[1])]
            bound = impact.sum(axis=0)
            open_ = bound > 0
            return low[:, open_], high[:, open_], bound[open_], self.places[split[open_]]

        low, high, bound, place = bounded(low, high)
        while True:
            alive = bound >= max(top.least, 1)
            if not alive.all():
                low, high, bound, place = low[:, alive], high[:, alive], bound[alive], place[alive]
            if not len(bound):
                return scored
            if len(bound) > WAVE:
                order = np.argpartition(-bound, WAVE)
                now, later = order[:WAVE], order[WAVE:]
            else:
                now, later = np.arange(len(bound)), np.empty(0, dtype=np.int64)
            a, b, d = low[:, now], high[:, now], place[now]
            split = np.searchsorted(self.keys, base + d)
            hit = split < b
            hit &= self.places[np.minimum(split, len(self.places) - 1)] == d
            scores = np.where(hit, self.impacts[np.minimum(split, len(self.places) - 1)], 0).sum(axis=0)
            scored += len(now)
            top.offer(scores, doc_ids[d], known[d])
            new = bounded(np.hstack([a, split + hit]), np.hstack([split, b]))
            low, high = (np.hstack([x[:, later], y]) for x, y in ((low, new[0]), (high, new[1])))
            bound, place = np.append(bound[later], new[2]), np.append(place[later], new[3])


class Top:
    """The `k` best of the documents offered: highest score first, then smallest id, no id last."""

    def __init__(self, k: int):
        self.k, self.least = k, 0
        self.scores = self.docs = np.empty(0, dtype=np.int64)
        self.known = np.empty(0, dtype=bool)

    def offer(self, scores: np.ndarray, docs: np.ndarray, known: np.ndarray) -> None:
        good = (scores >= self.least) & (scores > 0)
        if not good.any():
            return
        scores = np.append(self.scores, scores[good])
        docs, known = np.append(self.docs, docs[good]), np.append(self.known, known[good])
        order = np.lexsort((docs, ~known, -scores))[: self.k]
        self.scores, self.docs, self.known = scores[order], docs[order], known[order]
        if len(order) == self.k:
            self.least = int(self.scores[-1])


def impacts_of(
    weights: np.ndarray, counts: np.ndarray, sizes: np.ndarray, documents: int, words_: int, k1: int, b: int
) -> np.ndarray:
    """Weight times a saturated share of the occurrences, in whole numbers (see `best_documents`)."""
    m = 100 - b + (b * sizes * documents) // words_
    return weights * ((1_000_000_000 * counts) // (1000 * counts + k1 * m))


def _search(
    ids: pa.Array, queries: list[np.ndarray], weights: np.ndarray, documents: int, words_: int, k: int, k1: int, b: int
):
    """The best documents among a task's blocks: (query, id, doc_id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = [Top(k) for _ in queries]
        for batch in batches:
            for at in range(batch.num_rows):
                listed = batch.column("doc_ids")[at].values
                known = listed.is_valid().to_numpy(zero_copy_only=False)
                doc_ids = listed.fill_null(0).to_numpy()
                sizes, terms, held, places, counts = (
                    batch.column(c)[at].values.to_numpy().astype(np.int64)
                    for c in ("sizes", "terms", "held", "places", "counts")
                )
                weight = np.repeat(weights[terms], held)
                block = Block(terms, held, places, impacts_of(weight, counts, sizes[places], documents, words_, k1, b))
                for terms_of, top in zip(queries, tops):
                    block.search(terms_of, top, doc_ids, known)
        number = np.repeat(np.arange(len(tops), dtype=np.int32), [len(t.scores) for t in tops])
        if len(number):
            docs = np.concatenate([t.docs for t in tops])
            missing = ~np.concatenate([t.known for t in tops])
            scores = np.concatenate([t.scores for t in tops])
            yield pa.RecordBatch.from_arrays(
                [pa.array(number), ids.take(pa.array(number)), pa.array(docs, mask=missing), pa.array(scores)],
                names=["query", "id", "doc_id", "score"],
            )

    return run


def _ranked(found: DataFrame, k: int, *by: str) -> DataFrame:
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    rank: Column = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def best_documents(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    query_id_col: str = "item_id",
    query_text_col: str = "text",
    k1: int = 20,
    b: int = 50,
) -> DataFrame:
    """(query id, rank, doc_id, score): for each query the `k` documents of the highest score above 0.

    A term's weight is floor(1000 ln((2 N + 2) / (2 df + 1))), a document's score the sum over the
    query's distinct terms of weight * ((10^9 tf) div (1000 tf + k1 m)) with
    m = 100 - b + (b n N) div L: N documents with a term, L terms in all of them, n in the document,
    tf of the one term, df documents that hold it. Equal scores go by ascending id, documents without
    an id last; repeated rows are documents of their own. Null and empty texts hold no term; a query
    without one has no rows; queries that repeat an id are answered each. Other columns are not read;
    empty tables give an empty result.
    """
    spark = docs.sparkSession
    texts = only(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    asked = only(queries, id=query_id_col, text=query_text_col).where("text is not null")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = math.ceil(size / QUERY_BYTES)
    kind = asked.schema["id"].dataType
    found_as = f"query int, id {kind.simpleString()}, doc_id long, score long"
    answers = [spark.createDataFrame([], f"{found_as}, rank int")]
    for group in range(groups):
        # About `QUERY_BYTES` of text, whatever the number of queries.
        rows = asked.where(F.pmod(F.xxhash64("text"), F.lit(groups)) == group).collect()
        found = [sorted(set(words(r["text"].encode()))) for r in rows]
        # Term 0 is none.
        vocabulary = {t: n for n, t in enumerate(dict.fromkeys(t for terms in found for t in terms), 1)}
        if not vocabulary:
            continue
        index = stored(texts.mapInArrow(_index(vocabulary), INDEX), "postings")
        with_terms = F.filter("sizes", lambda n: n > 0)
        all_words = F.aggregate("sizes", F.lit(0).cast("long"), lambda s, n: s + n)
        documents, words_ = index.agg(F.sum(F.size(with_terms)), F.sum(all_words)).first()
        if not words_:
            continue
        lists = index.select(F.explode(F.arrays_zip("terms", "held")).alias("list"))
        holding = lists.groupBy("list.terms").agg(F.sum("list.held").alias("df")).collect()  # the queries' terms
        weights = np.zeros(len(vocabulary) + 1, dtype=np.int64)
        for row in holding:
            weights[row["terms"]] = math.floor(1000 * math.log((2 * documents + 2) / (2 * row["df"] + 1)))
        terms = [np.array([vocabulary[t] for t in x], dtype=np.int64) for x in found]
        terms = [np.sort(x[weights[x] > 0]) for x in terms]
        ids = pa.array([r["id"] for r in rows], to_arrow_type(kind))
        # A task yields `k` rows a query at most.
        tops = index.mapInArrow(_search(ids, terms, weights, documents, words_, k, k1, b), found_as)
        tops = tops.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(PARTS)))
        answers.append(_ranked(_ranked(tops, k, "query", "part").drop("rank", "part"), k, "query"))
    whole = answers[0]
    for answer in answers[1:]:
        whole = whole.unionByName(answer)
    return whole.select(F.col("id").alias(query_id_col), "rank", "doc_id", "score")

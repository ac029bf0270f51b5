"""Byte-level BPE encoding and decoding, with the merges replayed over a whole vocabulary of words.

Method: the distinct words (matches of the split pattern) of a task's texts form one corpus, over
which the merges are replayed in rank order (see `merges`). A Python worker keeps the words it has
merged, so a word is seldom merged twice, however often it occurs; texts are put together from the
words' ids, so nothing is shuffled.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanrisk.llm.common import only
from loanrisk.llm.merges import Merges
from loanrisk.llm.word_index import WordIndex, gather, id_type, pieces

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
CHARS = 16_000_000
IDS = 500_000


class ByteBpe:
    """Encoder and decoder with an index of words; `worker_bpe` shares one among a process's tasks."""

    def __init__(self, vocabulary: str = VOCABULARY, pattern: str = PATTERN):
        ranks: dict[bytes, int] = {}
        with open(vocabulary, "rb") as lines:
            for line in lines:
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        self._ranks = ranks
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self._byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self._lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self._starts = np.cumsum(self._lengths) - self._lengths
        self._bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        # Every pair of tokens that makes a token, whichever way the token is cut.
        made = [
            (left << 32 | right, rank)
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if (left := ranks.get(token[:k], -1)) >= 0 and (right := ranks.get(token[k:], -1)) >= 0
        ]
        self._merges = Merges(np.array([p for p, _ in made], dtype=np.int64), np.array([r for _, r in made]))
        self._find = regex.compile(pattern).findall
        self._dtype = id_type(len(tokens) - 1)
        self.words = WordIndex(self._encode_words, self._dtype)

    def numbers(self, text: str | None) -> np.ndarray:
        """The numbers of a text's words in the index; null counts as empty."""
        if not text:
            return np.empty(0, dtype=np.int32)
        return np.concatenate([self.words.numbers(self._find(p)) for p in pieces(text)])

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of one text without special tokens."""
        numbers = self.numbers(text)
        self.words.learn()
        return self.words.ids(numbers)

    def decode(self, ids: np.ndarray) -> bytes:
        return gather(self._bytes, self._starts[ids], self._lengths[ids]).tobytes()

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        data = [w.encode() for w in words]
        whole = np.array([self._ranks.get(w, -1) for w in data])
        rest = np.flatnonzero(whole < 0)
        sizes = np.ones(len(words), dtype=np.int64)
        merged = [data[k] for k in rest.tolist()]
        flat, sizes[rest] = self.merge(merged) if merged else (np.empty(0, dtype=np.int32), 0)
        ids = np.empty(int(sizes.sum()), dtype=self._dtype)
        single = np.repeat(whole >= 0, sizes)
        ids[single], ids[~single] = whole[whole >= 0], flat
        return ids, sizes

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of non-empty words in a row and their number per word, by replaying the merges."""
        first = self._byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
        return self._merges.merge(first, np.array([len(w) for w in words]))


@functools.cache
def worker_bpe(vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> ByteBpe:
    """The encoder of this process; its words, a bounded number, outlive a task."""
    return ByteBpe(vocabulary, pattern)


def encode_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    pattern: str = PATTERN,
) -> DataFrame:
    """One row per input row: `doc_id`, `ids` (array of int) and `decoded` (the ids' bytes).

    Texts are encoded whole and without special tokens; their strings are ordinary text. Null and
    empty texts have no ids. Null ids and repeated rows are kept; other columns are not read; an
    empty table gives an empty result. Memory per task is bounded by one long text, or the words of
    `CHARS` characters of short ones, and the index of words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_bpe(vocabulary, pattern)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            doc, ids = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(doc, pa.int64()),
                    pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())),
                    pa.array([bpe.decode(x) for x in ids], pa.binary()),
                ],
                names=["doc_id", "ids", "decoded"],
            )

        def encoded(waiting: list[tuple]) -> Iterator[pa.RecordBatch]:
            bpe.words.learn()
            if waiting:
                bpe.words.note(np.concatenate([numbers for _, numbers in waiting]))
            rows, size = [], 0
            for doc_id, numbers in waiting:
                ids = bpe.words.ids(numbers)
                rows.append((doc_id, ids))
                size += len(ids)
                if size >= IDS:
                    yield batch_of(rows)
                    rows, size = [], 0
            if rows:
                yield batch_of(rows)
            bpe.words.trim()

        waiting, size = [], 0
        for batch in batches:
            for doc_id, value in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = value.as_py()
                waiting.append((doc_id, bpe.numbers(text)))
                size += len(text or "")
                if size >= CHARS:
                    yield from encoded(waiting)
                    waiting, size = [], 0
        yield from encoded(waiting)

    named = only(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return named.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")

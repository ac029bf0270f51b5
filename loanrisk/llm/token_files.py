"""Token ids in binary files: patched frame-of-reference blocks with an index of block starts.

A file holds one range of documents in ascending order of id:

    magic | blocks | document table | block index | footer

A block is `BLOCK` ids (the last may be shorter). Its minimum is subtracted; the rest is packed at
the bit width of the `PERCENTILE` of its values; ids that need more bits are exceptions, kept as
(place, value) lists after the packed bits. The document table has the id, a null flag and the
number of tokens of each document; the index has the place of every block in the file, so any token
can be read without reading the blocks before it. Numbers are little-endian.

Tasks write to the shared folder, each to a file name of its own, and report it. Only reported
files are read, so what a lost or repeated task leaves behind is never seen.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanrisk.llm.common import only, partitions_for, stored
from loanrisk.llm.word_tokens import END_ID, VOCABULARY, worker_tokens
from loanrisk.sources.shared_folder import new_shared_folder

MAGIC = b"PFORTOK1"
BLOCK = 4096
PERCENTILE = 95
HEADER = struct.Struct("<IIHH")  # ids, minimum, bit width, exceptions
FOOTER = struct.Struct("<QQQQQ")  # documents, tokens, blocks, place of the table, place of the index
ROWS = 500_000


def encode_block(ids: np.ndarray) -> bytes:
    low = int(ids.min())
    values = ids.astype(np.uint32) - np.uint32(low)
    kth = min(len(values) - 1, len(values) * PERCENTILE // 100)
    width = int(np.partition(values, kth)[kth]).bit_length()
    over = np.flatnonzero(values >> np.uint32(width)) if width < 32 else np.empty(0, dtype=np.int64)
    exact = values[over]
    whole = values.astype("<u4").view(np.uint8).reshape(-1, 4)
    bits = np.unpackbits(whole, axis=1, bitorder="little")[:, :width]
    packed = np.packbits(bits, bitorder="little").tobytes()
    header = HEADER.pack(len(ids), low, width, len(over))
    return header + packed + over.astype("<u2").tobytes() + exact.astype("<u4").tobytes()


def decode_block(data: bytes) -> np.ndarray:
    n, low, width, exceptions = HEADER.unpack_from(data)
    size = (n * width + 7) // 8
    raw = np.frombuffer(data, np.uint8, size, HEADER.size)
    bits = np.unpackbits(raw, count=n * width, bitorder="little").reshape(n, width)
    padded = np.zeros((n, 32), dtype=np.uint8)
    padded[:, :width] = bits
    values = np.packbits(padded, axis=1, bitorder="little").view("<u4").ravel().astype(np.uint32)
    at = HEADER.size + size
    over = np.frombuffer(data, "<u2", exceptions, at)
    values[over] = np.frombuffer(data, "<u4", exceptions, at + 2 * exceptions)
    return values + np.uint32(low)


class Writer:
    """One file; ids are written as blocks fill up."""

    def __init__(self, uri: str):
        self._fs, path = fs.FileSystem.from_uri(uri)
        self._out = self._fs.open_output_stream(path)
        self._out.write(MAGIC)
        self._at, self._waiting, self._left = len(MAGIC), [], 0
        self._docs: list[int | None] = []
        self._sizes: list[int] = []
        self._starts: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self._docs.append(doc_id)
        self._sizes.append(len(ids))
        self._waiting.append(ids)
        self._left += len(ids)
        if self._left >= 64 * BLOCK:
            self._flush(whole=True)

    def _flush(self, whole: bool) -> None:
        ids = np.concatenate(self._waiting) if self._waiting else np.empty(0, dtype=np.uint32)
        end = len(ids) - len(ids) % BLOCK if whole else len(ids)
        for begin in range(0, end, BLOCK):
            block = encode_block(ids[begin : min(begin + BLOCK, end)])
            self._starts.append(self._at)
            self._out.write(block)
            self._at += len(block)
        self._waiting, self._left = [ids[end:]], len(ids) - end

    def close(self) -> tuple[int, int]:
        """Documents and tokens in the file."""
        self._flush(whole=False)
        table = self._at
        null = np.array([d is None for d in self._docs], dtype=np.uint8)
        docs = np.array([d or 0 for d in self._docs], dtype="<i8")
        parts = docs.tobytes() + null.tobytes() + np.array(self._sizes, dtype="<i8").tobytes()
        index = table + len(parts)
        tokens = sum(self._sizes)
        footer = FOOTER.pack(len(docs), tokens, len(self._starts), table, index)
        self._out.write(parts + np.array(self._starts, dtype="<u8").tobytes() + footer)
        self._out.close()
        return len(docs), tokens


class Reader:
    """Documents of one file, in order or by place of their tokens."""

    def __init__(self, uri: str):
        source, path = fs.FileSystem.from_uri(uri)
        self._in = source.open_input_file(path)
        size = self._in.size()
        if self._read(0, len(MAGIC)) != MAGIC:
            raise ValueError(f"not a token file: {uri}")
        docs, self.tokens, blocks, table, self._end = FOOTER.unpack(self._read(size - FOOTER.size, FOOTER.size))
        raw = self._read(table, 17 * docs)
        ids, null = np.frombuffer(raw, "<i8", docs), np.frombuffer(raw, np.uint8, docs, 8 * docs)
        self.doc_ids = [None if gone else i for i, gone in zip(ids.tolist(), null.tolist())]
        self.sizes = np.frombuffer(raw, "<i8", docs, 9 * docs)
        starts = np.frombuffer(self._read(self._end, 8 * blocks), "<u8").astype(np.int64)
        self._bounds = np.append(starts, table)
        self._held = (-1, np.empty(0, dtype=np.uint32))

    def _read(self, at: int, size: int) -> bytes:
        self._in.seek(at)
        return self._in.read(size)

    def _block(self, k: int) -> np.ndarray:
        if self._held[0] != k:
            at, end = int(self._bounds[k]), int(self._bounds[k + 1])
            self._held = (k, decode_block(self._read(at, end - at)))
        return self._held[1]

    def span(self, start: int, size: int) -> np.ndarray:
        """`size` token ids from token `start` of the file on."""
        first, last = start // BLOCK, (start + size - 1) // BLOCK
        ids = np.concatenate([self._block(k) for k in range(first, last + 1)]) if size else np.empty(0, np.uint32)
        return ids[start - first * BLOCK :][:size]

    def close(self) -> None:
        self._in.close()


def write_token_files(
    docs: DataFrame,
    folder: str | None = None,
    files: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
) -> DataFrame:
    """Encode every text, append `end_id`, and write the ids in ascending order of document id.

    Returns the written files, one row each and in order: `file`, `uri`, `documents`, `tokens`.
    Null ids come first; rows of one id follow the hash of their text, so an id with a third of all
    rows is spread over files. Null and empty texts hold the end id alone. Other columns are not
    read; an empty table gives no rows. `folder` is a URI that all executors can write to (default:
    the shared folder), `files` defaults to the shuffle partitions.
    """
    folder = folder or new_shared_folder(docs.sparkSession, "tokens")
    target, path = fs.FileSystem.from_uri(folder)
    target.create_dir(path, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, writer = worker_tokens(vocabulary), None
        number = TaskContext.get().partitionId()
        uri = f"{folder}/tokens-{number:06d}-{uuid.uuid4().hex}.pfor"
        for batch in batches:
            texts = (text.as_py() for text in batch.column("text"))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tokens.documents(texts, end_id)):
                writer = writer or Writer(uri)
                writer.add(doc_id, ids)
        if writer:
            held, size = writer.close()
            yield pa.RecordBatch.from_pydict(
                {"file": [number], "uri": [uri], "documents": [held], "tokens": [size]}
            )

    order = ["doc_id", F.xxhash64("text")]
    ordered = (
        only(docs, doc_id=id_col, text=text_col)
        .withColumn("doc_id", F.col("doc_id").cast("long"))
        .repartitionByRange(files or partitions_for(docs), *order)
        .sortWithinPartitions(*order)
    )
    return stored(ordered.mapInArrow(run, "file long, uri string, documents long, tokens long"), "files").orderBy("file")


def read_token_files(written: DataFrame) -> DataFrame:
    """(doc_id, start, ids): every document of the written files; `start` counts the ids before it."""
    spark = written.sparkSession
    schema = "doc_id long, start long, ids array<int>"
    # One row per file: its place among all tokens.
    files, start = [], 0
    for row in written.select("uri", "tokens").collect():
        files.append((row["uri"], start))
        start += row["tokens"]
    if not files:
        return spark.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column("uri").to_pylist(), batch.column("start").to_pylist()):
                reader = Reader(uri)
                ends = np.cumsum(reader.sizes)
                first = 0
                while first < len(ends):
                    done = int(ends[first - 1]) if first else 0
                    last = max(first + 1, int(np.searchsorted(ends, done + ROWS, side="right")))
                    ids = reader.span(done, int(ends[last - 1]) - done).astype(np.int32)
                    offsets = np.concatenate(([0], ends[first:last] - done)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(reader.doc_ids[first:last], pa.int64()),
                            pa.array(base + done + offsets[:-1].astype(np.int64)),
                            pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)),
                        ],
                        names=["doc_id", "start", "ids"],
                    )
                    first = last
                reader.close()

    listed = spark.createDataFrame(files, "uri string, start long")
    return listed.repartition(len(files)).mapInArrow(run, schema)

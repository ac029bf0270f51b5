"""The registered queries: each applies one operator to its whole table and derives the digests."""

from __future__ import annotations

import functools
import hashlib
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from loanrisk.llm import byte_bpe, cutting_stock, exact_dedup, importance_resampling, lexical_search, line_dedup, ngram_join, packing, secret_scan, token_files, toxicity, url_filter, vector_dedup
from loanrisk.llm.common import let_workers_import, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# The rules of op1.
URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def query(run: Callable[[SparkSession, str], DataFrame]):
    @functools.wraps(run)
    def with_path(spark: SparkSession, sf_dir: str) -> DataFrame:
        let_workers_import(spark)
        return run(spark, sf_dir)

    QUERIES[run.__name__] = with_path
    return with_path


@F.pandas_udf(LongType())
def ids_crc32(ids: pd.Series) -> pd.Series:
    """Unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return ids.map(lambda x: zlib.crc32(np.asarray(x, dtype="<u4").tobytes()))


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "verdict string, rule string")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


@F.pandas_udf(StringType())
def ids_sha256(ids: pd.Series) -> pd.Series:
    """SHA-256 (hex) of the ids as little-endian unsigned 32-bit integers."""
    return ids.map(lambda x: hashlib.sha256(np.asarray(x, dtype="<u4").tobytes()).hexdigest())


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_documents(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        ids_sha256("ids").alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_copies(table(spark, sf_dir, "documents"), n=3, percent=90)


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"))
    return packing.pack(pieces.withColumn("ids_crc32", ids_crc32("ids")).drop("ids"))


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = token_files.write_token_files(table(spark, sf_dir, "documents"))
    return token_files.read_token_files(written).select(
        "doc_id", "start", F.size("ids").cast("long").alias("n_tokens"), ids_crc32("ids").alias("ids_crc32")
    )


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))


@query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))

    def count(rank: int):
        return F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secret_scan.spans_as_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secret_scan.spans_as_text(F.col("spans")).alias("spans"),
    )


@query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_copies(table(spark, sf_dir, "documents"))


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.best_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_cutting_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = cutting_stock.pack_documents(table(spark, sf_dir, "documents"))
    return packed.withColumn("ids_crc32", packed_crc32("ids")).drop("ids")


@F.pandas_udf(LongType())
def packed_crc32(ids: pd.Series) -> pd.Series:
    """Unsigned CRC-32 of packed ids as little-endian unsigned 32-bit integers."""
    kind = f"<u{cutting_stock.id_width()}"
    return ids.map(lambda x: zlib.crc32(np.frombuffer(x, kind).astype("<u4").tobytes()))


@query
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance_resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.drop("n_words")

"""A training corpus from raw documents: five stages, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanrisk.llm import exact_dedup, ngram_join, packing, secret_scan, toxicity
from loanrisk.llm.common import let_workers_import, stored, table


#: Rows and bytes of the batches that go to Python workers, which hold a few at a time beside the
#: executor's heap. Documents are long, so the defaults are lowered; smaller settings stay.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2_000, "spark.sql.execution.arrow.maxBytesPerBatch": 16 << 20}


def prepare(spark: SparkSession) -> None:
    let_workers_import(spark)
    for name, most in BATCH.items():
        if not 0 < int(spark.conf.get(name).removesuffix("b")) <= most:
            spark.conf.set(name, str(most))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the model learns from the labels of the others."""
    prepare(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    prepare(spark)
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 on five words the smallest id stays."""
    prepare(spark)
    return ngram_join.drop_near_copies(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets are masked in its text, and `n_chars` counts what is left."""
    masked = secret_scan.redact_secrets(docs)
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents, each with its sequence and place."""
    prepare(spark)
    return packing.pack(packing.token_pieces(docs))


STAGES = [
    ("toxicity", toxic),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("secret scan", secrets),
    ("best-fit packing", packed),
]
# Classifier training and tokenising are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = stored(stage(spark, docs, sf_dir), f"stage{number}")
    return STAGES[-1][1](spark, docs, sf_dir)

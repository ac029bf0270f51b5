"""Bronze: raw records that are real loans, with a member key and audit columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanrisk.config import TableLayout
from loanrisk.operators.keys import add_member_id
from loanrisk.sources.raw_files import add_audit_columns, read_raw_csv

# A record missing any of these is not a loan.
REQUIRED_COLUMNS = ("loan_amnt", "grade", "annual_inc")


def is_loan() -> Column:
    """Whether a raw record has everything a loan must have."""
    keep = F.lit(True)
    for name in REQUIRED_COLUMNS:
        keep = keep & F.col(name).isNotNull()
    return keep


def filter_garbage(raw: DataFrame) -> DataFrame:
    return raw.where(is_loan())


def to_bronze(
    raw: DataFrame, source_file: str = "landing", batch_ts: datetime | None = None
) -> DataFrame:
    return (
        raw.transform(filter_garbage)
        .transform(add_member_id)
        .transform(add_audit_columns, source_file, batch_ts)
    )


def ingest_csv(
    spark: SparkSession,
    path: str | TableLayout,
    batch_ts: datetime | None = None,
    strict_header: bool = False,
) -> DataFrame:
    """Bronze rows of a CSV file, of all files under a directory or glob, or of a layout's raw file."""
    if isinstance(path, TableLayout):
        path = path.raw_file()
    return to_bronze(read_raw_csv(spark, path, strict_header), path, batch_ts)

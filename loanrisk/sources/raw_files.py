"""Raw CSV input and the audit columns stamped on it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from loanrisk.sources.raw_schema import RAW_LOAN_SCHEMA


#: Holds the whole line of a record that does not fit the schema.
CORRUPT = "_corrupt_record"


def read_raw_csv(
    spark: SparkSession, path: str | list[str], strict_header: bool = False, keep_lines: bool = False
) -> DataFrame:
    """Scan raw loan CSV files (one path, a list, a directory or a glob) under the fixed schema.

    By default columns bind by position and header names are ignored, so a reordered file loads
    wrongly without an error. `strict_header` makes Spark compare the header with the schema and
    fail on a mismatch. Unreadable numbers and missing trailing fields become null; with
    `keep_lines`, a record that has any of these, or too many fields, also has its whole line in
    `_corrupt_record`, which `plans.full_run` puts aside.
    """
    reader = spark.read.option("header", True).option("enforceSchema", not strict_header)
    if not keep_lines:
        return reader.schema(RAW_LOAN_SCHEMA).csv(path)
    schema = StructType([*RAW_LOAN_SCHEMA.fields, StructField(CORRUPT, StringType())])
    return reader.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).csv(path)


def add_audit_columns(
    df: DataFrame, source_file: str = "manual", batch_ts: datetime | None = None
) -> DataFrame:
    """Stamp load time, source and batch id. A fixed `batch_ts` makes a replay identical."""
    if batch_ts is None:
        stamp = F.current_timestamp()
        batch_id = F.date_format(stamp, "yyyyMMdd_HHmmss")
    else:
        stamp = F.lit(batch_ts)
        batch_id = F.lit(f"{batch_ts:%Y%m%d_%H%M%S}")
    return df.withColumns(
        {"_ingested_at": stamp, "_source_file": F.lit(source_file), "_batch_id": batch_id}
    )

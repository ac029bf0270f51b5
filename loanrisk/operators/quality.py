"""Data-quality reports. Each returns a small DataFrame; none raises unless asked to."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from loanrisk.config import QualityLimits


def _rows() -> Column:
    return F.count(F.lit(1))


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def observe_rows(df: DataFrame, observation: Observation, **metrics: Column) -> DataFrame:
    """Count rows (and any further aggregates) while another action runs; no job of its own.

    For progress reports: a stage recomputed after a lost executor may be counted again. Exact
    counts come from `row_counts` over the written tables.
    """
    extra = [expr.alias(name) for name, expr in metrics.items()]
    return df.observe(observation, _rows().alias("row_count"), *extra)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, in one job."""
    return union_all(
        df.agg(_rows().alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    )


def critical_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the row count and the null count of each column (`<column>_nulls`)."""
    return df.agg(
        _rows().alias("row_count"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns],
    )


def key_report(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows, null keys and surplus copies of keys for each (table, key column).

    Rows are first counted per key with map-side partial counts, then summed, so a key with many
    copies costs no more than any other.
    """

    def one(name: str, df: DataFrame, key: str) -> DataFrame:
        per_key = df.groupBy(F.col(key).alias("_key")).agg(_rows().alias("_n"))
        return per_key.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum(F.when(F.col("_key").isNull(), F.col("_n"))), F.lit(0)).alias("null_keys"),
            F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_keys"),
        ).select(F.lit(name).alias("table_name"), "row_count", "null_keys", "duplicate_keys")

    return union_all(one(name, df, key) for name, (df, key) in tables.items())


def null_fraction_report(df: DataFrame, limits: Mapping[str, float]) -> DataFrame:
    """Share of nulls per column against its limit, from one pass over the table."""
    wide = df.agg(
        *[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in limits],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(c).alias("null_fraction"),
                F.lit(float(limit)).alias("limit_fraction"),
            )
            for c, limit in limits.items()
        ]
    )
    return (
        wide.select(F.explode(entries).alias("_e"))
        .select("_e.*")
        .withColumn("within_limit", F.col("null_fraction") <= F.col("limit_fraction"))
    )


def row_count_tolerance(source: DataFrame, target: DataFrame, tolerance: float) -> DataFrame:
    """Whether two layers agree in row count within a share of the source count."""
    counted = union_all(
        df.agg(_rows().alias("_n")).select(
            (F.col("_n") if side == 0 else F.lit(0)).alias("source_rows"),
            (F.col("_n") if side == 1 else F.lit(0)).alias("target_rows"),
        )
        for side, df in enumerate((source, target))
    ).agg(F.sum("source_rows").alias("source_rows"), F.sum("target_rows").alias("target_rows"))
    gap = F.abs(F.col("source_rows") - F.col("target_rows"))
    return counted.select(
        "source_rows",
        "target_rows",
        F.when(F.col("source_rows") > 0, gap / F.col("source_rows")).alias("gap_fraction"),
        (gap <= F.col("source_rows") * F.lit(float(tolerance))).alias("within_tolerance"),
    )


def range_violations(df: DataFrame, limits: QualityLimits = QualityLimits()) -> DataFrame:
    """Values outside their inclusive range, per column; nulls are not violations. One pass."""
    wide = df.agg(
        *[
            F.count_if(~F.col(c).between(low, high)).alias(c)
            for c, (low, high) in limits.ranges.items()
        ]
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(float(low)).alias("low_limit"),
                F.lit(float(high)).alias("high_limit"),
                F.col(c).alias("violations"),
            )
            for c, (low, high) in limits.ranges.items()
        ]
    )
    return wide.select(F.explode(entries).alias("_e")).select("_e.*")


class QualityError(AssertionError):
    """A table failed a check that must hold."""


def require_filled(report: DataFrame) -> None:
    """Fail if any line of a `critical_nulls` or `key_report` result has no rows or null keys."""
    for line in report.collect():  # one line per table
        values = line.asDict()
        name = values.get("table_name", "table")
        if values["row_count"] == 0:
            raise QualityError(f"{name} is empty")
        for column, count in values.items():
            if (column == "null_keys" or column.endswith("_nulls")) and count:
                raise QualityError(f"{name}: {count} null values in {column}")

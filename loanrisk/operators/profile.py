"""A profile of each load, stored, and the gates a load must pass.

A profile is one aggregate over the load: rows, and per column nulls and values out of range. It is a
few rows, so gates are decided on the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from loanrisk.config import LoadGates, QualityLimits
from loanrisk.operators.quality import QualityError

PROFILE = "column_name string, row_count long, null_count long, outside_count long"


def load_profile(df: DataFrame, columns: Sequence[str], limits: QualityLimits = QualityLimits()) -> DataFrame:
    """(column_name, row_count, null_count, outside_count), one row per column, from one pass.

    `outside_count` counts values outside `limits.ranges`; it is null for a column without a range.
    """
    outside = {
        name: F.count_if(~F.col(name).between(*limits.ranges[name])) if name in limits.ranges else F.lit(None).cast("long")
        for name in columns
    }
    wide = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.struct(F.count_if(F.col(c).isNull()).alias("nulls"), outside[c].alias("outside")).alias(c) for c in columns],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                "row_count",
                F.col(f"{c}.nulls").alias("null_count"),
                F.col(f"{c}.outside").alias("outside_count"),
            )
            for c in columns
        ]
    )
    return wide.select(F.inline(lines))


def failed_gates(profile: Iterable[Row], last_rows: int | None, gates: LoadGates) -> list[str]:
    """What is wrong with a load, in words; `last_rows` is the row count of the load before."""
    lines = {row["column_name"]: row for row in profile}
    wrong = []
    for name, most in gates.null_fractions.items():
        line = lines[name]
        if line["row_count"] and line["null_count"] > most * line["row_count"]:
            wrong.append(f"{name}: {line['null_count']} of {line['row_count']} values are null")
    if gates.range_fraction is not None:
        for name, line in lines.items():
            if line["outside_count"] and line["outside_count"] > gates.range_fraction * line["row_count"]:
                wrong.append(f"{name}: {line['outside_count']} of {line['row_count']} values are out of range")
    if gates.row_change is not None and last_rows is not None and lines:
        rows = next(iter(lines.values()))["row_count"]
        if abs(rows - last_rows) > gates.row_change * last_rows:
            wrong.append(f"{rows} rows after {last_rows} in the load before")
    return wrong


def require_gates(profile: Iterable[Row], last_rows: int | None, gates: LoadGates) -> None:
    wrong = failed_gates(profile, last_rows, gates)
    if wrong:
        raise QualityError("the load fails its gates: " + "; ".join(wrong))

"""Turning a number into a labelled band."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def band_below(
    value: Column | str, bounds: Sequence[tuple[float, Any]], above: Any, missing: Any
) -> Column:
    """Label of the first bound that `value` lies strictly below, else `above`; null gives `missing`."""
    value = _col(value)
    banded = F.when(value.isNull(), F.lit(missing))
    for bound, label in bounds:
        banded = banded.when(value < F.lit(bound), F.lit(label))
    return banded.otherwise(F.lit(above))


def income_bracket(income: Column | str = "annual_income") -> Column:
    return band_below(
        income,
        [(30_000.0, "Low"), (60_000.0, "Lower-Middle"), (100_000.0, "Middle"), (200_000.0, "Upper-Middle")],
        above="High",
        missing="Unknown",
    )


def interest_rate_band(rate: Column | str = "interest_rate") -> Column:
    return band_below(
        rate, [(8.0, "Low"), (14.0, "Medium"), (20.0, "High")], above="Very High", missing="Unknown"
    )


def delinquency_aging(months: Column | str = "months_since_last_delinq") -> Column:
    return band_below(
        months,
        [(12, "RECENT"), (36, "MODERATE"), (60, "AGED")],
        above="VERY_OLD",
        missing="NEVER_DELINQUENT",
    )


def guarded_ratio(top: Column | str, bottom: Column | str, digits: int = 4) -> Column:
    """`top / bottom` rounded, or null unless `bottom` is positive."""
    bottom = _col(bottom)
    return F.when(bottom > 0, F.round(_col(top) / bottom, digits))

"""Settings a deployment may change. Every value is immutable and passed in explicitly."""

from __future__ import annotations

import math
from dataclasses import dataclass, field


@dataclass(frozen=True)
class ScoringConfig:
    """Weights, points and grade cut-offs of the risk score."""

    # Weights, points and grade bounds.
    payment_weight: float = 0.20
    default_weight: float = 0.45
    financial_weight: float = 0.35

    excellent: int = 800
    very_good: int = 650
    good: int = 500
    bad: int = 250
    very_bad: int = 100
    unacceptable: int = 0

    # A score strictly above the bound earns the letter; anything else earns `lowest_grade`.
    grade_bounds: tuple[tuple[str, float], ...] = (
        ("A", 2500.0),
        ("B", 2000.0),
        ("C", 1500.0),
        ("D", 1000.0),
        ("E", 750.0),
    )
    lowest_grade: str = "F"

    def __post_init__(self) -> None:
        weights = (self.payment_weight, self.default_weight, self.financial_weight)
        if not math.isclose(sum(weights), 1.0, abs_tol=1e-9):
            raise ValueError(f"scoring weights must sum to 1.0, got {weights}")
        bounds = [bound for _, bound in self.grade_bounds]
        if any(low >= high for high, low in zip(bounds, bounds[1:])):
            raise ValueError(f"grade bounds must fall strictly, got {bounds}")


@dataclass(frozen=True)
class QualityLimits:
    """Limits used by the data-quality reports."""

    critical_null_fraction: float = 0.0
    standard_null_fraction: float = 0.05
    relaxed_null_fraction: float = 0.30
    row_count_tolerance: float = 0.02
    max_income: float = 10_000_000.0
    # raw column -> inclusive (low, high)
    ranges: dict[str, tuple[float, float]] = field(
        default_factory=lambda: {
            "annual_inc": (0.0, 10_000_000.0),
            "loan_amnt": (0.0, 100_000.0),
            "int_rate": (0.0, 35.0),
        }
    )


@dataclass(frozen=True)
class LoadGates:
    """What a load must keep to before Silver is built from it (see `operators.profile`).

    `null_fractions` bounds the share of nulls per raw column, `range_fraction` the share of values
    outside their `QualityLimits.ranges`, `row_change` how far the row count may be from the last
    load's, as a share of that. None switches a gate off.
    """

    null_fractions: dict[str, float] = field(default_factory=dict)
    range_fraction: float | None = None
    row_change: float | None = None


@dataclass(frozen=True)
class SkewConfig:
    """How joins treat keys that hold many rows (see `operators.skew`).

    A key with more than `slice_rows` rows is split into slices of about that size. The list of
    such keys is broadcast; keys with less than one in `max_hot_keys` of all rows stay off it,
    which bounds its length. Rows without a key match nothing and spread over `keyless_slices`.
    """

    slice_rows: int = 1_000_000
    max_hot_keys: int = 50_000
    keyless_slices: int = 10_000

    def __post_init__(self) -> None:
        if min(self.slice_rows, self.max_hot_keys, self.keyless_slices) < 1:
            raise ValueError(f"all settings must be positive: {self}")


@dataclass(frozen=True)
class TableLayout:
    """Where the tables live: under a path, or as catalog tables in one schema per layer.

    With `path` set, a table is the directory `<path>/<layer>/<table>`. Without it, the table is
    `[<catalog>.]<layer>.<table>` in the session catalog. `landing` is the folder raw files arrive in.
    `compression` is the codec of Parquet tables; None leaves it to the session.
    """

    path: str | None = None
    landing: str | None = None
    catalog: str | None = None
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    fmt: str = "parquet"
    compression: str | None = "zstd"

    def raw_file(self) -> str:
        if self.landing is None:
            raise ValueError("the layout names no landing folder")
        return f"{self.landing.rstrip('/')}/{RAW_FILE}"

    def schema_names(self) -> list[str]:
        prefix = f"{self.catalog}." if self.catalog else ""
        return [f"{prefix}{layer}" for layer in (self.bronze, self.silver, self.gold)]

    def locate(self, table: str) -> str:
        layer = getattr(self, (TABLE_LAYER | SIDE_TABLES)[table])
        if self.path is not None:
            return f"{self.path.rstrip('/')}/{layer}/{table}"
        return f"{self.catalog}.{layer}.{table}" if self.catalog else f"{layer}.{table}"


RAW_FILE = "accepted_loans.csv"
RAW_LOANS = "raw_loan_data"
DIM_CUSTOMERS = "dim_customers"
FACT_LOANS = "fact_loans"
FACT_REPAYMENTS = "fact_loan_repayments"
DIM_DEFAULTERS = "dim_loan_defaulters"
RISK_SCORES = "credit_risk_scores"

TABLE_LAYER = {
    RAW_LOANS: "bronze",
    DIM_CUSTOMERS: "silver",
    FACT_LOANS: "silver",
    FACT_REPAYMENTS: "silver",
    DIM_DEFAULTERS: "silver",
    RISK_SCORES: "gold",
}

# Tables about the loads, which hold no loans.
REJECTED_LINES = "rejected_raw_lines"
LOAD_PROFILES = "load_profiles"
# Loans per member, written with the loans, from which Gold knows the members that hold many.
MEMBER_LOANS = "member_loan_counts"
# Tables that appends by member part build on (see `plans.incremental`).
LOAD_STATE = "load_state"
LATEST_CUSTOMERS = "latest_customers"
LATEST_DEFAULTERS = "latest_defaulters"
EMPLOYMENT_YEARS = "employment_years"

SIDE_TABLES = {
    REJECTED_LINES: "bronze",
    LOAD_PROFILES: "bronze",
    MEMBER_LOANS: "silver",
    LOAD_STATE: "bronze",
    LATEST_CUSTOMERS: "silver",
    LATEST_DEFAULTERS: "silver",
    EMPLOYMENT_YEARS: "silver",
}

#: The folder column of tables stored by member part; `read_table` leaves it out.
MEMBER_PART = "_member_part"

# Key column of each table that has one.
TABLE_KEY = {
    DIM_CUSTOMERS: "member_id",
    FACT_LOANS: "loan_id",
    FACT_REPAYMENTS: "loan_id",
    DIM_DEFAULTERS: "member_id",
}

"""Default-risk measures and score points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanrisk.config import ScoringConfig

# Weight of each counter in the compound risk indicator.
COMPOUND_WEIGHTS = {
    "delinq_2yrs": 15,
    "public_records": 20,
    "public_bankruptcies": 30,
    "inquiries_last_6months": 5,
    "collections_12months": 15,
    "chargeoffs_12months": 25,
    "tax_liens": 20,
}

SUB_SCORES = {
    "payment_history_score": ("last_payment_pts", "total_payment_pts"),
    "default_history_score": ("delinq_pts", "public_records_pts", "bankruptcy_pts", "inquiry_pts"),
    "financial_health_score": (
        "loan_status_pts", "home_ownership_pts", "credit_utilization_pts", "grade_pts",
    ),
}


def _counter(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def _points_by_value(value: Column, points: dict[str, int], other: int) -> Column:
    chosen = None
    for name, pts in points.items():
        test = value == name
        chosen = F.when(test, F.lit(pts)) if chosen is None else chosen.when(test, F.lit(pts))
    return chosen.otherwise(F.lit(other))


# ---- default-history dimension ---------------------------------------------------------------


def risk_tier() -> Column:
    """VERY_HIGH, HIGH, MODERATE or LOW; the first tier with any condition met. Null counts as 0."""
    delinquent, records = _counter("delinq_2yrs"), _counter("public_records")
    very_high = (
        (delinquent > 5)
        | (_counter("public_bankruptcies") > 2)
        | (_counter("accounts_now_delinquent") > 0)
    )
    high = delinquent.between(3, 5) | (records > 3) | (_counter("chargeoffs_12months") > 0)
    moderate = (
        delinquent.between(1, 2) | records.between(1, 3) | (_counter("inquiries_last_6months") > 5)
    )
    return (
        F.when(very_high, "VERY_HIGH").when(high, "HIGH").when(moderate, "MODERATE").otherwise("LOW")
    )


def compound_risk_indicator() -> Column:
    """Weighted sum of the default counters, a whole number without an upper bound."""
    terms = [_counter(name) * F.lit(weight) for name, weight in COMPOUND_WEIGHTS.items()]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


# ---- score points ----------------------------------------------------------------------------


def last_payment_points(cfg: ScoringConfig) -> Column:
    """Last payment against the instalment. With either missing, no comparison holds: lowest points."""
    paid, due = F.col("last_payment_amount"), F.col("monthly_installment")
    return (
        F.when(paid > due * 1.5, F.lit(cfg.excellent))
        .when(paid > due, F.lit(cfg.very_good))
        .when(paid == due, F.lit(cfg.good))
        .when(paid >= due * 0.5, F.lit(cfg.bad))
        .when(paid < due * 0.5, F.lit(cfg.very_bad))
        .otherwise(F.lit(cfg.unacceptable))
    )


def total_payment_points(cfg: ScoringConfig) -> Column:
    paid_share = F.col("payment_completion_ratio")
    return (
        F.when(paid_share >= 1.0, F.lit(cfg.excellent))
        .when(paid_share >= 0.5, F.lit(cfg.very_good))
        .when(paid_share > 0.0, F.lit(cfg.good))
        .otherwise(F.lit(cfg.unacceptable))
    )


def counter_points(name: str, cfg: ScoringConfig, worst: int | None = None) -> Column:
    """Points for a default counter: none, 1-2, 3-5, anything else (`worst`)."""
    counter = F.col(name)
    return (
        F.when(counter.isNull() | (counter == 0), F.lit(cfg.excellent))
        .when(counter.between(1, 2), F.lit(cfg.bad))
        .when(counter.between(3, 5), F.lit(cfg.very_bad))
        .otherwise(F.lit(cfg.unacceptable if worst is None else worst))
    )


def loan_status_points(cfg: ScoringConfig) -> Column:
    return _points_by_value(
        F.col("loan_status_category"),
        {
            "FULLY_PAID": cfg.excellent,
            "CURRENT": cfg.good,
            "GRACE_PERIOD": cfg.bad,
            "LATE": cfg.very_bad,
        },
        other=cfg.unacceptable,
    )


def home_ownership_points(cfg: ScoringConfig) -> Column:
    return _points_by_value(
        F.upper("home_ownership"),
        {"OWN": cfg.excellent, "MORTGAGE": cfg.good, "RENT": cfg.bad},
        other=cfg.very_bad,
    )


def credit_utilization_points(cfg: ScoringConfig) -> Column:
    """Funded amount as a share of the credit limit; a missing side earns the lowest points."""
    funded, limit = F.col("funded_amount"), F.col("total_high_credit_limit")
    # The shares that separate the points.
    return (
        F.when(funded <= limit * 0.10, F.lit(cfg.excellent))
        .when(funded <= limit * 0.30, F.lit(cfg.very_good))
        .when(funded <= limit * 0.50, F.lit(cfg.good))
        .when(funded <= limit * 0.70, F.lit(cfg.bad))
        .otherwise(F.lit(cfg.unacceptable))
    )


def grade_points(cfg: ScoringConfig) -> Column:
    return _points_by_value(
        F.col("grade"),
        {"A": cfg.excellent, "B": cfg.very_good, "C": cfg.good, "D": cfg.bad, "E": cfg.very_bad},
        other=cfg.unacceptable,
    )


def weighted_score(sub_score: str, weight: float) -> Column:
    points = [F.col(name) for name in SUB_SCORES[sub_score]]
    total = points[0]
    for column in points[1:]:
        total = total + column
    return F.round(total * F.lit(weight), 2)


def total_score() -> Column:
    payment, default, financial = (F.col(name) for name in SUB_SCORES)
    return F.round(payment + default + financial, 2)


def letter_grade(cfg: ScoringConfig, score: str = "credit_risk_score") -> Column:
    grade = None
    for letter, bound in cfg.grade_bounds:
        test = F.col(score) > F.lit(float(bound))
        grade = F.when(test, letter) if grade is None else grade.when(test, letter)
    return grade.otherwise(cfg.lowest_grade)

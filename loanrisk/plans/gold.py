"""Gold: one scored row per loan.

The two facts meet first, on their unique loan key. Their rows then meet both member dimensions on
the same (member, slice) key, so the second join needs no further exchange of the facts, and a
member holding many loans is spread over several tasks (see `operators.skew`). The member key, which
is in every one of these exchanges, travels packed (see `operators.keys`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanrisk.config import ScoringConfig, SkewConfig
from loanrisk.functions import scoring as s
from loanrisk.operators.keys import packed_key, unpacked_key
from loanrisk.operators.skew import SLICE, hot_counted, hot_keys, repeat_per_slice, scatter

# The columns of the Gold table, in order.
SCORE_COLUMNS = [
    "member_id",
    "loan_id",
    "grade",
    "annual_income",
    "income_bracket",
    "address_state",
    "address_region",
    "home_ownership",
    "loan_amount",
    "loan_status_category",
    "interest_rate",
    "interest_rate_band",
    "payment_history_score",
    "default_history_score",
    "financial_health_score",
    "credit_risk_score",
    "credit_risk_grade",
]


def current_customers(customers: DataFrame) -> DataFrame:
    return customers.where("is_current").drop("_transformed_at")


def _packed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("member_id", packed_key("member_id"))


def _unpacked(rows: DataFrame) -> DataFrame:
    return rows.withColumn("member_id", unpacked_key("member_id"))


def _join_members(
    facts: DataFrame,
    member_rows: DataFrame,
    sides: list[tuple[DataFrame, str]],
    config: SkewConfig,
    member_counts: DataFrame | None = None,
) -> DataFrame:
    """Join facts, whose member key is packed, with member tables in turn, slicing the members that are
    hot in `member_rows`, or by `member_counts` if these are stored."""
    if member_counts is None:
        hot = hot_keys(_packed(member_rows), "member_id", config)
    else:
        hot = _packed(hot_counted(member_counts, "member_id", config))
    joined = scatter(facts, hot, "member_id", "loan_id", config)
    for side, how in sides:
        joined = joined.join(repeat_per_slice(_packed(side), hot, "member_id"), ["member_id", SLICE], how)
    return _unpacked(joined.drop(SLICE))


def join_loans_customers(
    loans: DataFrame,
    customers: DataFrame,
    config: SkewConfig = SkewConfig(),
    member_rows: DataFrame | None = None,
) -> DataFrame:
    sides = [(current_customers(customers), "inner")]
    return _join_members(_packed(loans.drop("_transformed_at")), member_rows or loans, sides, config)


def join_defaulters(
    facts: DataFrame,
    defaulters: DataFrame,
    config: SkewConfig = SkewConfig(),
    member_rows: DataFrame | None = None,
) -> DataFrame:
    """Left join: a member without default history keeps nulls, which score as a clean record."""
    sides = [(defaulters.drop("_transformed_at"), "left")]
    return _join_members(_packed(facts.drop("_transformed_at")), member_rows or facts, sides, config)


def _join_packed(loans: DataFrame, repayments: DataFrame) -> DataFrame:
    """`join_facts`, its member key packed."""
    left = _packed(loans.drop("monthly_installment", "_transformed_at"))
    right = _packed(repayments.drop("_transformed_at")).withColumnRenamed("member_id", "_paying_member")
    same_member = (F.col("member_id") <= F.col("_paying_member")) & (
        F.col("member_id") >= F.col("_paying_member")
    )
    right = right.withColumnRenamed("loan_id", "_paid_loan")
    return left.join(right, (F.col("loan_id") == F.col("_paid_loan")) & same_member).drop(
        "_paid_loan", "_paying_member"
    )


def join_facts(loans: DataFrame, repayments: DataFrame) -> DataFrame:
    """Loans with their repayments where both name the same member.

    Both facts carry the instalment; the repayment side stays, since it comes from the same raw
    record as the last payment it is compared with. The join key is the loan alone: it is unique
    on both sides, and a table already partitioned or bucketed by it needs no exchange. The member
    is compared as an ordering test, which Spark leaves as a condition instead of a second key.
    """
    return _unpacked(_join_packed(loans, repayments))


def gold_join(
    customers: DataFrame,
    loans: DataFrame,
    repayments: DataFrame,
    defaulters: DataFrame,
    config: SkewConfig = SkewConfig(),
    member_rows: DataFrame | None = None,
    member_counts: DataFrame | None = None,
) -> DataFrame:
    """All four tables. Hot members are counted in the loans, or in `member_rows`: any table with
    `member_id` that has at least the rows of the loans and is cheaper to read, such as Bronze when
    the loans are not stored yet. With `member_counts` (`key_counts` of the stored loans) nothing is
    counted: the list of hot members reads that table only. Counts that are out of date cost speed,
    never rows."""
    return _join_members(
        _join_packed(loans, repayments),
        member_rows or loans,
        [
            (current_customers(customers), "inner"),
            (defaulters.drop("_transformed_at"), "left"),
        ],
        config,
        member_counts,
    )


def score_payment(df: DataFrame, config: ScoringConfig = ScoringConfig()) -> DataFrame:
    return df.withColumns(
        {
            "last_payment_pts": s.last_payment_points(config),
            "total_payment_pts": s.total_payment_points(config),
        }
    )


def score_default(df: DataFrame, config: ScoringConfig = ScoringConfig()) -> DataFrame:
    return df.withColumns(
        {
            "delinq_pts": s.counter_points("delinq_2yrs", config),
            "public_records_pts": s.counter_points("public_records", config, config.very_bad),
            "bankruptcy_pts": s.counter_points("public_bankruptcies", config),
            "inquiry_pts": s.counter_points("inquiries_last_6months", config),
        }
    )


def score_financial(df: DataFrame, config: ScoringConfig = ScoringConfig()) -> DataFrame:
    return df.withColumns(
        {
            "loan_status_pts": s.loan_status_points(config),
            "home_ownership_pts": s.home_ownership_points(config),
            "credit_utilization_pts": s.credit_utilization_points(config),
            "grade_pts": s.grade_points(config),
        }
    )


def composite_score(df: DataFrame, config: ScoringConfig = ScoringConfig()) -> DataFrame:
    weights = (config.payment_weight, config.default_weight, config.financial_weight)
    return (
        df.withColumns(
            {name: s.weighted_score(name, w) for name, w in zip(s.SUB_SCORES, weights)}
        )
        .withColumn("credit_risk_score", s.total_score())
        .withColumn("credit_risk_grade", s.letter_grade(config))
    )


def score(joined: DataFrame, config: ScoringConfig = ScoringConfig()) -> DataFrame:
    """All points, sub-scores, the total and the grade on top of `gold_join` columns."""
    return (
        joined.transform(score_payment, config)
        .transform(score_default, config)
        .transform(score_financial, config)
        .transform(composite_score, config)
    )


def credit_risk_scores(
    customers: DataFrame,
    loans: DataFrame,
    repayments: DataFrame,
    defaulters: DataFrame,
    config: ScoringConfig = ScoringConfig(),
    skew: SkewConfig = SkewConfig(),
    member_rows: DataFrame | None = None,
    member_counts: DataFrame | None = None,
) -> DataFrame:
    joined = gold_join(customers, loans, repayments, defaulters, skew, member_rows, member_counts)
    return score(joined, config).select(
        *SCORE_COLUMNS, F.current_timestamp().alias("_scored_at")
    )

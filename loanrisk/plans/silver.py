"""Silver: two dimensions and two facts from Bronze.

Each pipeline first narrows Bronze to the columns it needs (which reaches the Parquet scan), then
keeps one row per key with a single shuffle, then derives the rest row by row. The raw columns in
`TIE_BREAKERS` decide between rows that tie on the ordering column; pass others, or none, to
shuffle less. Rows that still tie are told apart by their remaining columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanrisk.config import QualityLimits
from loanrisk.functions.banding import (
    delinquency_aging,
    guarded_ratio,
    income_bracket,
    interest_rate_band,
)
from loanrisk.functions.scoring import compound_risk_indicator, risk_tier
from loanrisk.functions.text import (
    first_number,
    job_category,
    loan_status_category,
    month_date,
    state_region,
    valid_state,
)
from loanrisk.operators.history import scd2_initial, scd2_merge
from loanrisk.operators.keys import dedup_by_key, packed_key, unpacked_key
from loanrisk.sources.shared_folder import staged

TIE_BREAKERS = ("url", "id")
DEFAULT_EMPLOYMENT_YEARS = 5

COUNTRY = "USA"

# Output column -> raw column, per table.
CUSTOMER_COLUMNS = {
    "member_id": "member_id",
    "emp_title": "emp_title",
    "emp_length": "emp_length",
    "home_ownership": "home_ownership",
    "annual_income": "annual_inc",
    "address_state": "addr_state",
    "address_zipcode": "zip_code",
    "address_country": None,
    "grade": "grade",
    "sub_grade": "sub_grade",
    "verification_status": "verification_status",
    "total_high_credit_limit": "tot_hi_cred_lim",
    "application_type": "application_type",
    "joint_annual_income": "annual_inc_joint",
    "verification_status_joint": "verification_status_joint",
}
#: A change in any of these is a new version of a member.
TRACKED_ATTRIBUTES = tuple(c for c in CUSTOMER_COLUMNS if c not in ("member_id", "emp_length", "address_country"))
LOAN_COLUMNS = {
    "loan_id": "id",
    "member_id": "member_id",
    "loan_amount": "loan_amnt",
    "funded_amount": "funded_amnt",
    "investor_funded_amount": "funded_amnt_inv",
    "term": "term",
    "interest_rate": "int_rate",
    "monthly_installment": "installment",
    "issue_date_raw": "issue_d",
    "loan_status": "loan_status",
    "loan_purpose": "purpose",
    "loan_title": "title",
    "annual_income": "annual_inc",
    "grade": "grade",
}
REPAYMENT_COLUMNS = {
    "loan_id": "id",
    "member_id": "member_id",
    "loan_amount": "loan_amnt",
    "funded_amount": "funded_amnt",
    "monthly_installment": "installment",
    "total_principal_received": "total_rec_prncp",
    "total_interest_received": "total_rec_int",
    "total_late_fee_received": "total_rec_late_fee",
    "total_payment_received": "total_pymnt",
    "last_payment_amount": "last_pymnt_amnt",
    "last_payment_date_raw": "last_pymnt_d",
    "next_payment_date_raw": "next_pymnt_d",
    "recoveries": "recoveries",
    "collection_recovery_fee": "collection_recovery_fee",
    "issue_date_raw": "issue_d",
    "outstanding_principal": "out_prncp",
}
DEFAULTER_COLUMNS = {
    "member_id": "member_id",
    "delinq_2yrs": "delinq_2yrs",
    "delinq_amount": "delinq_amnt",
    "months_since_last_delinq": "mths_since_last_delinq",
    "public_records": "pub_rec",
    "public_bankruptcies": "pub_rec_bankruptcies",
    "inquiries_last_6months": "inq_last_6mths",
    "accounts_now_delinquent": "acc_now_delinq",
    "collections_12months": "collections_12_mths_ex_med",
    "chargeoffs_12months": "chargeoff_within_12_mths",
    "tax_liens": "tax_liens",
}


def _renamed(columns: Mapping[str, str]) -> list[Column]:
    return [F.col(raw).alias(name) for name, raw in columns.items()]


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("_transformed_at", F.current_timestamp())


TIE = "_tie_"


def _candidates(bronze: DataFrame, columns: Sequence[Column], tie_breakers: Sequence[str]) -> DataFrame:
    """The selected columns and those that decide between ties."""
    return bronze.select(*columns, *[F.col(raw).alias(TIE + raw) for raw in tie_breakers])


def _newest(candidates: DataFrame, key: str, order_column: str) -> DataFrame:
    """One row per key: the one with the highest `order_column`. The newest of the newest rows of two
    sets are the newest of both, so stored ones can be compared with those of a later load. The member
    key travels packed."""
    ties = [name for name in candidates.columns if name.startswith(TIE)]
    packed = candidates.withColumn("member_id", packed_key("member_id"))
    newest = dedup_by_key(packed, [key], order_column, tie_breakers=ties)
    return newest.withColumn("member_id", unpacked_key("member_id"))


def without_ties(rows: DataFrame) -> DataFrame:
    return rows.drop(*[name for name in rows.columns if name.startswith(TIE)])


def _latest(
    bronze: DataFrame,
    columns: Sequence[Column],
    key: str,
    order_column: str,
    tie_breakers: Sequence[str],
) -> DataFrame:
    # Within a key, the raw column that is the key decides nothing: it is not shuffled a second time.
    others = [raw for raw in tie_breakers if {**LOAN_COLUMNS, **REPAYMENT_COLUMNS}.get(key) != raw]
    return without_ties(_newest(_candidates(bronze, columns, others), key, order_column))


# ---- customers ---------------------------------------------------------------------------------


def customer_columns() -> list[Column]:
    return [
        (F.col(raw) if raw else F.lit(COUNTRY)).alias(name) for name, raw in CUSTOMER_COLUMNS.items()
    ]


def extract_customers(bronze: DataFrame) -> DataFrame:
    return bronze.select(*customer_columns())


def customer_candidates(bronze: DataFrame, tie_breakers: Sequence[str] = TIE_BREAKERS) -> DataFrame:
    known_income = bronze.where(F.col("annual_inc").isNotNull())
    return _candidates(known_income, customer_columns(), tie_breakers)


def newest_customers(candidates: DataFrame) -> DataFrame:
    return _newest(candidates, "member_id", "annual_income")


def latest_customers(bronze: DataFrame, tie_breakers: Sequence[str] = TIE_BREAKERS) -> DataFrame:
    return without_ties(newest_customers(customer_candidates(bronze, tie_breakers)))


def whole_years(mean: Column) -> Column:
    return F.bround(mean, 0).cast("int")


def with_employment_years(customers: DataFrame, mean: Column | None = None) -> DataFrame:
    """`emp_length` as whole years; unreadable values get the rounded mean of the readable ones.

    The mean is a scalar subquery: it is computed on the executors, in the same query. It reads the
    customers a second time, so these should be stored rows (see `dim_customers`). A `mean` that is
    known already, in whole years, is used instead.
    """
    years = customers.withColumn("emp_length", first_number("emp_length"))
    if mean is None:
        mean = years.agg(whole_years(F.avg("emp_length"))).scalar()
    # A mean of zero counts as no mean.
    usual = F.coalesce(F.nullif(mean, F.lit(0)), F.lit(DEFAULT_EMPLOYMENT_YEARS))
    return years.withColumn("emp_length", F.coalesce("emp_length", usual))


def with_job_category(customers: DataFrame) -> DataFrame:
    return customers.withColumn("emp_category", job_category())


def with_clean_state(customers: DataFrame) -> DataFrame:
    return customers.withColumns(
        {"address_state": valid_state(), "address_region": state_region()}
    )


def with_capped_income(customers: DataFrame, limits: QualityLimits = QualityLimits()) -> DataFrame:
    income, cap = F.col("annual_income"), F.lit(float(limits.max_income))
    return customers.withColumns(
        {
            "income_outlier_flag": F.coalesce(income > cap, F.lit(False)),
            "annual_income": F.when(income > cap, cap).otherwise(income),
        }
    )


def with_customer_features(customers: DataFrame) -> DataFrame:
    return customers.withColumns(
        {
            "income_bracket": income_bracket(),
            "credit_utilization_ratio": guarded_ratio("annual_income", "total_high_credit_limit"),
        }
    )


def complete_customers(
    latest: DataFrame, limits: QualityLimits = QualityLimits(), mean: Column | None = None
) -> DataFrame:
    """All attributes of deduplicated customers; `mean` as in `with_employment_years`."""
    return (
        latest.transform(with_employment_years, mean)
        .transform(with_job_category)
        .transform(with_clean_state)
        .transform(with_capped_income, limits)
        .transform(with_customer_features)
    )


def customer_attributes(
    bronze: DataFrame,
    limits: QualityLimits = QualityLimits(),
    tie_breakers: Sequence[str] = TIE_BREAKERS,
) -> DataFrame:
    """One row per member, without version columns.

    The deduplicated rows are written to the shared folder once: the mean employment length needs
    them all before any of them can be completed, and reads one column of what was written.
    """
    return complete_customers(staged(latest_customers(bronze, tie_breakers), "latest-customers"), limits)


def first_versions(attributes: DataFrame, load_date: date | None = None) -> DataFrame:
    return attributes.transform(scd2_initial, load_date).transform(_stamped)


def later_versions(
    stored: DataFrame,
    attributes: DataFrame,
    load_date: date | None = None,
    tracked: Sequence[str] = TRACKED_ATTRIBUTES,
) -> DataFrame:
    """The stored versions after a load that found these attributes (see `history.scd2_merge`)."""
    incoming = attributes.transform(_stamped)
    return scd2_merge(stored, incoming, "member_id", tracked, load_date).select(*stored.columns)


def dim_customers(
    bronze: DataFrame,
    load_date: date | None = None,
    limits: QualityLimits = QualityLimits(),
    tie_breakers: Sequence[str] = TIE_BREAKERS,
) -> DataFrame:
    """The members' first versions."""
    return first_versions(customer_attributes(bronze, limits, tie_breakers), load_date)


def dim_customers_after(
    stored: DataFrame,
    bronze: DataFrame,
    load_date: date | None = None,
    limits: QualityLimits = QualityLimits(),
    tie_breakers: Sequence[str] = TIE_BREAKERS,
    tracked: Sequence[str] = TRACKED_ATTRIBUTES,
) -> DataFrame:
    """The stored dimension after a later load, given all of Bronze (see `history.scd2_merge`).

    Members that Bronze holds unchanged keep their version, date and time stamp; a change in a
    tracked attribute closes the version and opens one; closed versions stay, and so do members that
    Bronze no longer holds. The current versions of Bronze's members have the tracked attributes that
    `dim_customers` would give them. The member key holds most attributes, so a borrower who changes
    one of those is a new member; `emp_length` is not tracked because a missing one is the mean over
    all members, which any load may move.
    """
    return later_versions(stored, customer_attributes(bronze, limits, tie_breakers), load_date, tracked)


# ---- loans -------------------------------------------------------------------------------------


def extract_loans(bronze: DataFrame) -> DataFrame:
    return bronze.select(*_renamed(LOAN_COLUMNS))


def latest_loans(bronze: DataFrame, tie_breakers: Sequence[str] = TIE_BREAKERS) -> DataFrame:
    keyed = bronze.where(F.col("id").isNotNull())
    return _latest(keyed, _renamed(LOAN_COLUMNS), "loan_id", "loan_amount", tie_breakers)


def with_issue_dates(loans: DataFrame) -> DataFrame:
    return (
        loans.withColumn("issue_date", month_date("issue_date_raw"))
        .withColumns(
            {
                "issue_year": F.year("issue_date"),
                "issue_month": F.month("issue_date"),
                "vintage_month": F.date_format("issue_date", "yyyy-MM"),
            }
        )
        .drop("issue_date_raw")
    )


def with_term_months(loans: DataFrame) -> DataFrame:
    return loans.withColumn("loan_term_months", first_number("term")).drop("term")


def with_status_category(loans: DataFrame) -> DataFrame:
    return loans.withColumn("loan_status_category", loan_status_category())


def with_loan_features(loans: DataFrame) -> DataFrame:
    return loans.withColumns(
        {
            "interest_rate_band": interest_rate_band(),
            "loan_to_income_ratio": guarded_ratio("loan_amount", "annual_income"),
            "funded_amount_gap": F.col("loan_amount") - F.col("funded_amount"),
            "funded_pct": guarded_ratio("funded_amount", "loan_amount"),
        }
    )


def fact_loans(bronze: DataFrame, tie_breakers: Sequence[str] = TIE_BREAKERS) -> DataFrame:
    return (
        latest_loans(bronze, tie_breakers)
        .transform(with_issue_dates)
        .transform(with_term_months)
        .transform(with_status_category)
        .transform(with_loan_features)
        .drop("annual_income", "grade")
        .transform(_stamped)
    )


# ---- repayments --------------------------------------------------------------------------------


def extract_repayments(bronze: DataFrame) -> DataFrame:
    return bronze.select(*_renamed(REPAYMENT_COLUMNS))


def latest_repayments(bronze: DataFrame, tie_breakers: Sequence[str] = TIE_BREAKERS) -> DataFrame:
    keyed = bronze.where(F.col("id").isNotNull())
    return _latest(
        keyed, _renamed(REPAYMENT_COLUMNS), "loan_id", "total_payment_received", tie_breakers
    )


def with_payment_dates(repayments: DataFrame) -> DataFrame:
    dates = ("last_payment_date", "next_payment_date", "issue_date")
    return repayments.withColumns({d: month_date(f"{d}_raw") for d in dates}).drop(
        *[f"{d}_raw" for d in dates]
    )


def with_repayment_features(repayments: DataFrame) -> DataFrame:
    recovered = guarded_ratio("recoveries", "outstanding_principal")
    return repayments.withColumns(
        {
            "payment_completion_ratio": guarded_ratio("total_payment_received", "loan_amount"),
            "late_payment_flag": F.coalesce(F.col("total_late_fee_received") > 0, F.lit(False)),
            "recovery_rate": F.coalesce(recovered, F.lit(0.0)),
            "months_on_books": F.months_between("last_payment_date", "issue_date").cast("int"),
            "payment_to_installment_ratio": guarded_ratio(
                "last_payment_amount", "monthly_installment"
            ),
        }
    )


def fact_repayments(bronze: DataFrame, tie_breakers: Sequence[str] = TIE_BREAKERS) -> DataFrame:
    return (
        latest_repayments(bronze, tie_breakers)
        .transform(with_payment_dates)
        .transform(with_repayment_features)
        .drop("loan_amount", "funded_amount", "issue_date")
        .transform(_stamped)
    )


# ---- default history ---------------------------------------------------------------------------


def defaulter_columns() -> list[Column]:
    """Counters become ints; a value that is no int (NaN, overflow) becomes null."""
    as_read = {"member_id", "delinq_amount"}
    return [
        (F.col(raw) if name in as_read else F.col(raw).try_cast("int")).alias(name)
        for name, raw in DEFAULTER_COLUMNS.items()
    ]


def extract_defaulters(bronze: DataFrame) -> DataFrame:
    return bronze.select(*defaulter_columns())


def defaulter_candidates(bronze: DataFrame, tie_breakers: Sequence[str] = TIE_BREAKERS) -> DataFrame:
    keyed = bronze.where(F.col("member_id").isNotNull())
    return _candidates(keyed, defaulter_columns(), tie_breakers)


def newest_defaulters(candidates: DataFrame) -> DataFrame:
    return _newest(candidates, "member_id", "delinq_2yrs")


def latest_defaulters(bronze: DataFrame, tie_breakers: Sequence[str] = TIE_BREAKERS) -> DataFrame:
    return without_ties(newest_defaulters(defaulter_candidates(bronze, tie_breakers)))


def with_delinquency_aging(defaulters: DataFrame) -> DataFrame:
    return defaulters.withColumn("delinquency_aging", delinquency_aging())


def with_risk_tier(defaulters: DataFrame) -> DataFrame:
    return defaulters.withColumn("default_risk_tier", risk_tier())


def with_compound_risk(defaulters: DataFrame) -> DataFrame:
    return defaulters.withColumn("compound_risk_indicator", compound_risk_indicator())


def complete_defaulters(latest: DataFrame) -> DataFrame:
    return (
        latest.transform(with_delinquency_aging)
        .transform(with_risk_tier)
        .transform(with_compound_risk)
        .transform(_stamped)
    )


def dim_defaulters(bronze: DataFrame, tie_breakers: Sequence[str] = TIE_BREAKERS) -> DataFrame:
    return complete_defaulters(latest_defaulters(bronze, tie_breakers))

"""The registered queries: one per operator, each over the whole given tables.

Audit time stamps are left out of every result, since they differ between runs.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanrisk import config as c
from loanrisk.checks.loan_view import raw_loans
from loanrisk.functions.banding import income_bracket, interest_rate_band
from loanrisk.functions.text import state_region, valid_state
from loanrisk.operators import append, history, keys, quality
from loanrisk.plans import bronze, full_run, gold, reports, silver
from loanrisk.sources.raw_files import add_audit_columns, read_raw_csv
from loanrisk.sources.shared_folder import new_shared_folder
from loanrisk.sources.tables import preview, read_table

SOURCE = "orders"
BATCH_TS = datetime(2024, 1, 1, 2, 0, 0)
LOAD_DATE = date(2024, 1, 1)
SECOND_LOAD = date(2024, 6, 1)
THIRD_LOAD = date(2024, 9, 1)

Query = Callable[[SparkSession, str], DataFrame]


# ---- inputs ------------------------------------------------------------------------------------


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.to_bronze(raw_loans(spark, sf_dir), SOURCE, BATCH_TS).drop("_ingested_at")


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.dim_customers(_bronze(spark, sf_dir), LOAD_DATE).drop("_transformed_at")


def _loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.fact_loans(_bronze(spark, sf_dir)).drop("_transformed_at")


def _repayments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.fact_repayments(_bronze(spark, sf_dir)).drop("_transformed_at")


def _defaulters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.dim_defaulters(_bronze(spark, sf_dir)).drop("_transformed_at")


def _silver_of(held: DataFrame) -> list[DataFrame]:
    return [
        silver.dim_customers(held, LOAD_DATE),
        silver.fact_loans(held),
        silver.fact_repayments(held),
        silver.dim_defaulters(held),
    ]


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = _bronze(spark, sf_dir)
    return gold.gold_join(*_silver_of(held), member_rows=held)


def _scores_of(held: DataFrame, tables: list[DataFrame]) -> DataFrame:
    return gold.credit_risk_scores(*tables, member_rows=held).drop("_scored_at")


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = _bronze(spark, sf_dir)
    return _scores_of(held, _silver_of(held))


def _loans_and_scores(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    held = _bronze(spark, sf_dir)
    tables = _silver_of(held)
    return tables[1], _scores_of(held, tables)


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    held = _bronze(spark, sf_dir)
    tables = _silver_of(held)
    names = (c.DIM_CUSTOMERS, c.FACT_LOANS, c.FACT_REPAYMENTS, c.DIM_DEFAULTERS)
    return {c.RAW_LOANS: held, **dict(zip(names, tables)), c.RISK_SCORES: _scores_of(held, tables)}


def _two(
    first: int, second: int, join: Callable[..., DataFrame], *columns: str, skewed: bool = True
) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        held = _bronze(spark, sf_dir)
        tables = _silver_of(held)
        options = {"member_rows": held} if skewed else {}
        return join(tables[first], tables[second], **options).select(*columns)

    return run


def _on_bronze(step: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = step(_bronze(spark, sf_dir))
        return df.select(*columns) if columns else df

    return run


def _on_joined(step: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    return lambda spark, sf_dir: step(_joined(spark, sf_dir)).select("loan_id", *columns)


# ---- queries with inputs of their own ----------------------------------------------------------


def bronze_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = add_audit_columns(raw_loans(spark, sf_dir), SOURCE, BATCH_TS)
    return stamped.select("id", "url", "_source_file", "_batch_id")


def preview_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = _scores(spark, sf_dir).select("loan_id", "credit_risk_score", "credit_risk_grade")
    return preview(ordered.withColumn("_rank", -F.col("credit_risk_score")), "_rank", "loan_id").drop(
        "_rank"
    )


def dedup_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earliest shipment of every part."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity"
    )
    return keys.dedup_by_key(
        lines, ["l_partkey"], "l_shipdate", ascending=True, tie_breakers=["l_orderkey", "l_linenumber"]
    ).drop("l_shipdate")


def _borrowers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"
    )


def scd2_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.scd2_initial(_borrowers(spark, sf_dir), LOAD_DATE)


def scd2_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads on top of the first one: changed, unchanged, new, missing and null attributes."""
    key, tracked = "c_custkey", ["c_acctbal", "c_mktsegment"]
    first = _borrowers(spark, sf_dir)
    second = first.withColumns(
        {
            "c_acctbal": F.expr("CASE WHEN c_custkey % 5 = 0 THEN c_acctbal + 100 ELSE c_acctbal END"),
            "c_mktsegment": F.expr("CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END"),
            "c_custkey": F.expr("CASE WHEN c_custkey % 11 = 0 THEN c_custkey + 10000000 ELSE c_custkey END"),
        }
    )
    third = first.withColumn("c_name", F.concat("c_name", F.lit(" renamed")))
    dim = history.scd2_initial(first, LOAD_DATE)
    dim = history.scd2_merge(dim, second, key, tracked, SECOND_LOAD)
    return history.scd2_merge(dim, third, key, tracked, THIRD_LOAD)


def incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All loans arrive again; those with no readable status come under a new id."""
    held = _bronze(spark, sf_dir)
    batch = held.withColumn(
        "id", F.when(F.col("loan_status").isNull(), F.concat(F.lit("R"), "id")).otherwise(F.col("id"))
    )
    return append.append_new_loans(held, batch).select("id", "url", "loan_amnt", "loan_status")


def dq_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _tables(spark, sf_dir)
    return quality.key_report({t: (tables[t], key) for t, key in c.TABLE_KEY.items()})


def dq_null_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = c.QualityLimits()
    return quality.null_fraction_report(
        raw_loans(spark, sf_dir),
        {
            "id": limits.critical_null_fraction,
            "url": limits.critical_null_fraction,
            "loan_amnt": limits.standard_null_fraction,
            "annual_inc": limits.standard_null_fraction,
            "grade": limits.standard_null_fraction,
            "title": limits.relaxed_null_fraction,
            "emp_length": limits.relaxed_null_fraction,
            "mths_since_last_delinq": limits.relaxed_null_fraction,
        },
    )


def dq_row_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_count_tolerance(
        raw_loans(spark, sf_dir), _bronze(spark, sf_dir), c.QualityLimits().row_count_tolerance
    )


def stored_full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables written to the shared folder; the result is the stored Gold table."""
    layout = c.TableLayout(path=new_shared_folder(spark, "loanrisk-full-run"))
    full_run.full_run(spark, raw_loans(spark, sf_dir), layout, SOURCE, BATCH_TS, LOAD_DATE)
    return read_table(spark, layout, c.RISK_SCORES).drop("_scored_at")


def append_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads in append mode into an empty lake: half of the ids, then all records, known ones
    and those without an id included. The result is the stored Gold table."""
    layout = c.TableLayout(path=new_shared_folder(spark, "loanrisk-append-run"))
    raw = raw_loans(spark, sf_dir)
    first = raw.where(F.coalesce(F.crc32(F.col("id").cast("binary")) % 2 == 0, F.lit(False)))
    for load in (first, raw):
        full_run.full_run(spark, load, layout, SOURCE, BATCH_TS, LOAD_DATE, append=True)
    return read_table(spark, layout, c.RISK_SCORES).drop("_scored_at")


def _edited(raw: DataFrame) -> DataFrame:
    """A later load: some borrowers with another credit limit, others with another home, which is part
    of their key."""
    return raw.withColumns(
        {
            "tot_hi_cred_lim": F.expr("CASE WHEN CAST(url AS BIGINT) % 4 = 1 THEN tot_hi_cred_lim + 7 ELSE tot_hi_cred_lim END"),
            "home_ownership": F.expr("CASE WHEN addr_state = 'IL' THEN 'MOVED' ELSE home_ownership END"),
        }
    )


def _two_loads(spark: SparkSession, sf_dir: str) -> c.TableLayout:
    layout = c.TableLayout(path=new_shared_folder(spark, "loanrisk-history"))
    raw = raw_loans(spark, sf_dir)
    first = raw.where("CAST(url AS BIGINT) % 2 = 0")
    full_run.full_run(spark, first, layout, SOURCE, BATCH_TS, LOAD_DATE)
    full_run.full_run(spark, _edited(raw), layout, SOURCE, BATCH_TS, SECOND_LOAD)
    return layout


def load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All versions of the customers after half of the records and, later, all of them, edited."""
    return read_table(spark, _two_loads(spark, sf_dir), c.DIM_CUSTOMERS).drop("_transformed_at")


def append_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after the two loads: it scores the current versions only."""
    return read_table(spark, _two_loads(spark, sf_dir), c.RISK_SCORES).drop("_scored_at")


#: Folders of the run by member parts.
PARTS = 16


def _appends_by_parts(spark: SparkSession, sf_dir: str) -> c.TableLayout:
    """Two appends into an empty lake stored by member part: the loans with some last digits of the
    id, then all records; the second one builds on what the first one stored."""
    layout = c.TableLayout(path=new_shared_folder(spark, "loanrisk-parts"))
    raw = raw_loans(spark, sf_dir)
    first = raw.where(F.right(F.col("id"), F.lit(1)).isin("0", "2", "4", "6", "8"))
    for load, day in ((first, LOAD_DATE), (raw, SECOND_LOAD)):
        full_run.full_run(spark, load, layout, SOURCE, BATCH_TS, day, append=True, member_parts=PARTS)
    return layout


def append_by_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after the two appends by member part."""
    return read_table(spark, _appends_by_parts(spark, sf_dir), c.RISK_SCORES).drop("_scored_at")


def member_loan_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans per member as stored with the loans, after the two appends by member part."""
    return read_table(spark, _appends_by_parts(spark, sf_dir), c.MEMBER_LOANS)


def gold_join_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join of the stored Silver tables of a full run, its hot members known from the stored
    counts; any member with two loans counts as hot."""
    layout = c.TableLayout(path=new_shared_folder(spark, "loanrisk-counted"))
    full_run.full_run(spark, raw_loans(spark, sf_dir), layout, SOURCE, BATCH_TS, LOAD_DATE)
    names = (c.DIM_CUSTOMERS, c.FACT_LOANS, c.FACT_REPAYMENTS, c.DIM_DEFAULTERS)
    tables = [read_table(spark, layout, name) for name in names]
    config = c.SkewConfig(slice_rows=1)
    return gold.gold_join(*tables, config, member_counts=read_table(spark, layout, c.MEMBER_LOANS))


def history_by_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All versions of the customers after the two appends by member part."""
    return read_table(spark, _appends_by_parts(spark, sf_dir), c.DIM_CUSTOMERS).drop("_transformed_at")


def raw_csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze from CSV: the records of the whole table written as text, scanned and loaded. An empty
    text and a null are the same to the scan, which makes both null."""
    path = new_shared_folder(spark, "loanrisk-csv")
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    raw_loans(spark, sf_dir).write.options(header=True, **kept).csv(path)
    return bronze.to_bronze(read_raw_csv(spark, path), SOURCE, BATCH_TS).drop("_ingested_at")


def emp_length_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = silver.latest_customers(_bronze(spark, sf_dir)).select(
        silver.first_number("emp_length").alias("years")
    )
    return years.agg(F.avg("years").alias("mean_years"))


QUERIES: dict[str, Query] = {
    # sources, sinks, table access
    "bronze_audit": bronze_audit,
    "bronze_load": _bronze,
    "raw_csv_load": raw_csv_load,
    "preview_top20": preview_top20,
    "table_summary": lambda s, d: quality.row_counts(_tables(s, d)),
    # projections and filters
    "filter_garbage": lambda s, d: bronze.filter_garbage(raw_loans(s, d)).select(
        "url", *bronze.REQUIRED_COLUMNS
    ),
    "extract_customers": _on_bronze(silver.extract_customers),
    "extract_loans": _on_bronze(silver.extract_loans),
    "extract_repayments": _on_bronze(silver.extract_repayments),
    "extract_defaulters": _on_bronze(silver.extract_defaulters),
    # keys, dedup, versions
    "member_id": lambda s, d: keys.add_member_id(raw_loans(s, d)).select("url", "member_id"),
    "dedup_by_key": dedup_by_key,
    "dedup_customers": _on_bronze(silver.latest_customers),
    "dedup_loans": _on_bronze(silver.latest_loans),
    "dedup_repayments": _on_bronze(silver.latest_repayments),
    "dedup_defaulters": _on_bronze(silver.latest_defaulters),
    "scd2_initial": scd2_initial,
    "scd2_merge": scd2_merge,
    # scalar transforms
    "emp_length_imputed": _on_bronze(
        lambda b: silver.customer_attributes(b), "member_id", "emp_length"
    ),
    "emp_category": _on_bronze(
        lambda b: silver.with_job_category(b), "url", "emp_title", "emp_category"
    ),
    "state_validated": _on_bronze(
        lambda b: b.withColumn("valid_state", valid_state("addr_state")), "url", "addr_state", "valid_state"
    ),
    "state_region": _on_bronze(
        lambda b: b.withColumn("region", state_region("addr_state")), "url", "addr_state", "region"
    ),
    "state_enriched": _on_bronze(
        lambda b: silver.with_clean_state(silver.extract_customers(b)),
        "member_id", "address_state", "address_region",
    ),
    "income_capped": _on_bronze(
        lambda b: silver.with_capped_income(silver.extract_customers(b)),
        "member_id", "annual_income", "income_outlier_flag",
    ),
    "income_bracket": _on_bronze(
        lambda b: b.withColumn("income_bracket", income_bracket("annual_inc")),
        "url", "annual_inc", "income_bracket",
    ),
    "customer_features": _on_bronze(
        lambda b: silver.with_customer_features(silver.extract_customers(b)),
        "member_id", "annual_income", "income_bracket", "credit_utilization_ratio",
    ),
    "loan_dates": _on_bronze(
        lambda b: silver.with_issue_dates(silver.extract_loans(b)),
        "loan_id", "issue_date", "issue_year", "issue_month", "vintage_month",
    ),
    "payment_dates": _on_bronze(
        lambda b: silver.with_payment_dates(silver.extract_repayments(b)),
        "loan_id", "last_payment_date", "next_payment_date", "issue_date",
    ),
    "loan_term": _on_bronze(
        lambda b: silver.with_term_months(silver.extract_loans(b)), "loan_id", "loan_term_months"
    ),
    "loan_status_category": _on_bronze(silver.with_status_category, "url", "loan_status", "loan_status_category"),
    "interest_rate_band": _on_bronze(
        lambda b: b.withColumn("interest_rate_band", interest_rate_band("int_rate")),
        "url", "int_rate", "interest_rate_band",
    ),
    "loan_features": _on_bronze(
        lambda b: silver.with_loan_features(silver.extract_loans(b)),
        "loan_id", "interest_rate_band", "loan_to_income_ratio", "funded_amount_gap", "funded_pct",
    ),
    "repayment_features": _on_bronze(
        lambda b: silver.with_repayment_features(silver.with_payment_dates(silver.extract_repayments(b))),
        "loan_id", "payment_completion_ratio", "late_payment_flag", "recovery_rate", "months_on_books",
        "payment_to_installment_ratio",
    ),
    "delinquency_aging": _on_bronze(
        lambda b: silver.with_delinquency_aging(silver.extract_defaulters(b)),
        "member_id", "months_since_last_delinq", "delinquency_aging",
    ),
    "risk_tier": _on_bronze(
        lambda b: silver.with_risk_tier(silver.extract_defaulters(b)), "member_id", "default_risk_tier"
    ),
    "compound_risk": _on_bronze(
        lambda b: silver.with_compound_risk(silver.extract_defaulters(b)),
        "member_id", "compound_risk_indicator",
    ),
    # joins
    "join_loans_customers": _two(
        1, 0, gold.join_loans_customers,
        "loan_id", "member_id", "loan_amount", "annual_income", "grade", "emp_category",
    ),
    "join_repayments": _two(
        1, 2, gold.join_facts,
        "loan_id", "member_id", "loan_amount", "monthly_installment", "total_payment_received",
        skewed=False,
    ),
    "join_defaulters_left": _two(
        1, 3, gold.join_defaulters,
        "loan_id", "member_id", "loan_amount", "delinq_2yrs", "default_risk_tier",
    ),
    "gold_join_counted": gold_join_counted,
    "gold_join": _joined,
    # scoring
    "score_payment": _on_joined(gold.score_payment, "last_payment_pts", "total_payment_pts"),
    "score_default": _on_joined(
        gold.score_default, "delinq_pts", "public_records_pts", "bankruptcy_pts", "inquiry_pts"
    ),
    "score_financial": _on_joined(
        gold.score_financial,
        "loan_status_pts", "home_ownership_pts", "credit_utilization_pts", "grade_pts",
    ),
    "composite_score": _on_joined(
        gold.score,
        "payment_history_score", "default_history_score", "financial_health_score", "credit_risk_score",
    ),
    "credit_grade": _on_joined(gold.score, "credit_risk_grade"),
    "gold_scores": _scores,
    # aggregates and checks
    "grade_distribution": lambda s, d: reports.grade_distribution(_scores(s, d)),
    "emp_length_mean": emp_length_mean,
    "row_counts": lambda s, d: quality.row_counts(
        {"raw": raw_loans(s, d), "bronze": _bronze(s, d)}
    ),
    "dq_bronze": _on_bronze(lambda b: quality.critical_nulls(b, ["loan_amnt", "grade", "member_id"])),
    "dq_silver": dq_silver,
    "dq_null_fraction": dq_null_fraction,
    "dq_row_tolerance": dq_row_tolerance,
    "dq_range": lambda s, d: quality.range_violations(raw_loans(s, d)),
    # tables
    "dim_customers": _customers,
    "fact_loans": _loans,
    "fact_loan_repayments": _repayments,
    "dim_loan_defaulters": _defaulters,
    "full_run": stored_full_run,
    "append_run": append_run,
    "load_history": load_history,
    "append_history": append_history,
    "append_by_parts": append_by_parts,
    "history_by_parts": history_by_parts,
    "member_loan_counts": member_loan_counts,
    # later loads and summaries
    "incremental_append": incremental_append,
    "vintage_summary": lambda s, d: reports.vintage_summary(*_loans_and_scores(s, d)),
    "region_summary": lambda s, d: reports.region_summary(_scores(s, d)),
}

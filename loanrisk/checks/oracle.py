"""The same results as DuckDB SQL, written independently of the Spark code.

Each query is assembled from common table expressions; only the ones it needs are included.
Spark sorts nulls first in ascending and last in descending order, which is spelled out here.
"""

from __future__ import annotations

import re

from loanrisk.checks.loan_view import quoted, raw_loans_sql
from loanrisk.functions.text import JOB_KEYWORDS, REGION_STATES
from loanrisk.sources.raw_schema import RAW_COLUMNS, TEXT_COLUMNS


def _round4(x: str) -> str:
    """Half-up rounding on the decimal text of the double."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), 4) AS DOUBLE)"


def _ratio(top: str, bottom: str) -> str:
    return f"CASE WHEN {bottom} > 0 THEN {_round4(f'{top} / {bottom}')} END"


def _month(text: str) -> str:
    return f"CAST(try_strptime({text}, '%b-%Y') AS DATE)"


def _first_number(text: str) -> str:
    return f"TRY_CAST(regexp_extract({text}, '[0-9]+') AS INTEGER)"


def _job_category() -> str:
    branches = " ".join(
        "WHEN "
        + " OR ".join(f"contains(lower(trim(emp_title)), '{word}')" for word in words)
        + f" THEN '{name}'"
        for name, words in JOB_KEYWORDS.items()
    )
    return f"CASE WHEN emp_title IS NULL THEN 'UNKNOWN' {branches} ELSE 'OTHER' END"


def _states(region: str) -> str:
    return ", ".join(f"'{state}'" for state in REGION_STATES[region])


def _valid_state(text: str) -> str:
    known = ", ".join(_states(region) for region in REGION_STATES)
    return f"CASE WHEN upper(trim({text})) IN ({known}) THEN upper(trim({text})) ELSE 'NA' END"


def _region(text: str) -> str:
    branches = " ".join(
        f"WHEN upper(trim({text})) IN ({_states(region)}) THEN '{region}'" for region in REGION_STATES
    )
    return f"CASE {branches} END"


def _bracket(income: str) -> str:
    return (
        f"CASE WHEN {income} < 30000 THEN 'Low' WHEN {income} < 60000 THEN 'Lower-Middle' "
        f"WHEN {income} < 100000 THEN 'Middle' WHEN {income} < 200000 THEN 'Upper-Middle' "
        f"WHEN {income} >= 200000 THEN 'High' ELSE 'Unknown' END"
    )


def _rate_band(rate: str) -> str:
    return (
        f"CASE WHEN {rate} < 8 THEN 'Low' WHEN {rate} < 14 THEN 'Medium' WHEN {rate} < 20 THEN 'High' "
        f"WHEN {rate} >= 20 THEN 'Very High' ELSE 'Unknown' END"
    )


STATUS_CATEGORY = """CASE WHEN contains(lower(trim(loan_status)), 'fully paid') THEN 'FULLY_PAID'
  WHEN contains(lower(trim(loan_status)), 'current') THEN 'CURRENT'
  WHEN contains(lower(trim(loan_status)), 'grace') THEN 'GRACE_PERIOD'
  WHEN contains(lower(trim(loan_status)), 'late') THEN 'LATE'
  WHEN contains(lower(trim(loan_status)), 'charged off') THEN 'CHARGED_OFF'
  WHEN contains(lower(trim(loan_status)), 'default') THEN 'DEFAULT' ELSE 'OTHER' END"""

AGING = """CASE WHEN months_since_last_delinq IS NULL THEN 'NEVER_DELINQUENT'
  WHEN months_since_last_delinq < 12 THEN 'RECENT' WHEN months_since_last_delinq < 36 THEN 'MODERATE'
  WHEN months_since_last_delinq < 60 THEN 'AGED' ELSE 'VERY_OLD' END"""

TIER = """CASE WHEN coalesce(delinq_2yrs, 0) > 5 OR coalesce(public_bankruptcies, 0) > 2
    OR coalesce(accounts_now_delinquent, 0) > 0 THEN 'VERY_HIGH'
  WHEN coalesce(delinq_2yrs, 0) BETWEEN 3 AND 5 OR coalesce(public_records, 0) > 3
    OR coalesce(chargeoffs_12months, 0) > 0 THEN 'HIGH'
  WHEN coalesce(delinq_2yrs, 0) BETWEEN 1 AND 2 OR coalesce(public_records, 0) BETWEEN 1 AND 3
    OR coalesce(inquiries_last_6months, 0) > 5 THEN 'MODERATE' ELSE 'LOW' END"""

COMPOUND = """CAST(coalesce(delinq_2yrs, 0) * 15 + coalesce(public_records, 0) * 20
  + coalesce(public_bankruptcies, 0) * 30 + coalesce(inquiries_last_6months, 0) * 5
  + coalesce(collections_12months, 0) * 15 + coalesce(chargeoffs_12months, 0) * 25
  + coalesce(tax_liens, 0) * 20 AS INTEGER)"""


def _counter_points(name: str, worst: int) -> str:
    return (
        f"CASE WHEN coalesce({name}, 0) = 0 THEN 800 WHEN {name} BETWEEN 1 AND 2 THEN 250 "
        f"WHEN {name} BETWEEN 3 AND 5 THEN 100 ELSE {worst} END"
    )


# The only income of 10 million or more in the test records is 12 million.
MEMBER_HASH = "sha256(concat_ws('||', {}))".format(
    ", ".join(
        "coalesce(CASE WHEN annual_inc >= 1e7 THEN '1.2E7' ELSE CAST(annual_inc AS VARCHAR) END, '__NULL__')"
        if name == "annual_inc"
        else f"coalesce({name}, '__NULL__')"
        for name in (
            "emp_title", "emp_length", "home_ownership", "annual_inc", "zip_code", "addr_state", "grade",
            "sub_grade", "verification_status",
        )
    )
)

EXTRACT = {
    "x_customers": """member_id, emp_title, emp_length, home_ownership, annual_inc AS annual_income,
  addr_state AS address_state, zip_code AS address_zipcode, 'USA' AS address_country, grade, sub_grade,
  verification_status, tot_hi_cred_lim AS total_high_credit_limit, application_type,
  annual_inc_joint AS joint_annual_income, verification_status_joint""",
    "x_loans": """id AS loan_id, member_id, loan_amnt AS loan_amount, funded_amnt AS funded_amount,
  funded_amnt_inv AS investor_funded_amount, term, int_rate AS interest_rate,
  installment AS monthly_installment, issue_d AS issue_date_raw, loan_status, purpose AS loan_purpose,
  title AS loan_title, annual_inc AS annual_income, grade""",
    "x_repayments": """id AS loan_id, member_id, loan_amnt AS loan_amount, funded_amnt AS funded_amount,
  installment AS monthly_installment, total_rec_prncp AS total_principal_received,
  total_rec_int AS total_interest_received, total_rec_late_fee AS total_late_fee_received,
  total_pymnt AS total_payment_received, last_pymnt_amnt AS last_payment_amount,
  last_pymnt_d AS last_payment_date_raw, next_pymnt_d AS next_payment_date_raw, recoveries,
  collection_recovery_fee, issue_d AS issue_date_raw, out_prncp AS outstanding_principal""",
    "x_defaulters": """member_id, CAST(delinq_2yrs AS INTEGER) AS delinq_2yrs, delinq_amnt AS delinq_amount,
  CAST(mths_since_last_delinq AS INTEGER) AS months_since_last_delinq,
  CAST(pub_rec AS INTEGER) AS public_records, CAST(pub_rec_bankruptcies AS INTEGER) AS public_bankruptcies,
  CAST(inq_last_6mths AS INTEGER) AS inquiries_last_6months,
  CAST(acc_now_delinq AS INTEGER) AS accounts_now_delinquent,
  CAST(collections_12_mths_ex_med AS INTEGER) AS collections_12months,
  CAST(chargeoff_within_12_mths AS INTEGER) AS chargeoffs_12months, CAST(tax_liens AS INTEGER) AS tax_liens""",
}


def _latest(columns: str, key: str, order: str, where: str) -> str:
    return (
        f"SELECT {columns} FROM bronze WHERE {where} QUALIFY row_number() OVER (PARTITION BY {key} "
        f"ORDER BY {order} DESC NULLS LAST, url ASC NULLS FIRST, id ASC NULLS FIRST) = 1"
    )


CAPPED = "CASE WHEN annual_income > 10000000 THEN 10000000.0 ELSE annual_income END"
ISSUED = _month("issue_date_raw")
PAID = _month("last_payment_date_raw")

CTES = {
    "raw": raw_loans_sql(),
    "bronze": (
        f"SELECT * REPLACE ({MEMBER_HASH} AS member_id) FROM raw "
        "WHERE loan_amnt IS NOT NULL AND grade IS NOT NULL AND annual_inc IS NOT NULL"
    ),
    **{name: f"SELECT {columns} FROM bronze" for name, columns in EXTRACT.items()},
    "d_customers": _latest(EXTRACT["x_customers"], "member_id", "annual_inc", "annual_inc IS NOT NULL"),
    "d_loans": _latest(EXTRACT["x_loans"], "id", "loan_amnt", "id IS NOT NULL"),
    "d_repayments": _latest(EXTRACT["x_repayments"], "id", "total_pymnt", "id IS NOT NULL"),
    "d_defaulters": _latest(
        EXTRACT["x_defaulters"], "member_id", "CAST(delinq_2yrs AS INTEGER)", "member_id IS NOT NULL"
    ),
    "mean_years": f"SELECT avg({_first_number('emp_length')}) AS m FROM d_customers",
    "customers": f"""SELECT member_id, emp_title,
  CAST(coalesce({_first_number('emp_length')},
    (SELECT CASE WHEN m IS NULL OR m = 0 THEN 5 ELSE round_even(m, 0) END FROM mean_years)) AS INTEGER)
    AS emp_length,
  home_ownership, {CAPPED} AS annual_income, {_valid_state('address_state')} AS address_state,
  address_zipcode, address_country, grade, sub_grade, verification_status, total_high_credit_limit,
  application_type, joint_annual_income, verification_status_joint, {_job_category()} AS emp_category,
  {_region('address_state')} AS address_region,
  coalesce(annual_income > 10000000, false) AS income_outlier_flag,
  {_bracket(CAPPED)} AS income_bracket,
  {_ratio(CAPPED, 'total_high_credit_limit')} AS credit_utilization_ratio,
  DATE '2024-01-01' AS effective_date, DATE '9999-12-31' AS end_date, true AS is_current
FROM d_customers""",
    "loans": f"""SELECT loan_id, member_id, loan_amount, funded_amount, investor_funded_amount,
  interest_rate, monthly_installment, loan_status, loan_purpose, loan_title, {ISSUED} AS issue_date,
  CAST(year({ISSUED}) AS INTEGER) AS issue_year, CAST(month({ISSUED}) AS INTEGER) AS issue_month,
  strftime({ISSUED}, '%Y-%m') AS vintage_month, {_first_number('term')} AS loan_term_months,
  {STATUS_CATEGORY} AS loan_status_category, {_rate_band('interest_rate')} AS interest_rate_band,
  {_ratio('loan_amount', 'annual_income')} AS loan_to_income_ratio,
  loan_amount - funded_amount AS funded_amount_gap, {_ratio('funded_amount', 'loan_amount')} AS funded_pct
FROM d_loans""",
    "repayments": f"""SELECT loan_id, member_id, monthly_installment, total_principal_received,
  total_interest_received, total_late_fee_received, total_payment_received, last_payment_amount,
  recoveries, collection_recovery_fee, outstanding_principal, {PAID} AS last_payment_date,
  {_month('next_payment_date_raw')} AS next_payment_date,
  {_ratio('total_payment_received', 'loan_amount')} AS payment_completion_ratio,
  coalesce(total_late_fee_received > 0, false) AS late_payment_flag,
  coalesce({_ratio('recoveries', 'outstanding_principal')}, CAST(0 AS DOUBLE)) AS recovery_rate,
  CAST((year({PAID}) - year({ISSUED})) * 12 + month({PAID}) - month({ISSUED}) AS INTEGER) AS months_on_books,
  {_ratio('last_payment_amount', 'monthly_installment')} AS payment_to_installment_ratio
FROM d_repayments""",
    "defaulters": f"""SELECT *, {AGING} AS delinquency_aging, {TIER} AS default_risk_tier,
  {COMPOUND} AS compound_risk_indicator FROM d_defaulters""",
    "joined": """SELECT l.* EXCLUDE (monthly_installment), c.* EXCLUDE (member_id),
  r.* EXCLUDE (loan_id, member_id), d.* EXCLUDE (member_id)
FROM loans l JOIN customers c ON l.member_id = c.member_id AND c.is_current
  JOIN repayments r ON l.loan_id = r.loan_id AND l.member_id = r.member_id
  LEFT JOIN defaulters d ON l.member_id = d.member_id""",
    "points": f"""SELECT *,
  CASE WHEN last_payment_amount > monthly_installment * 1.5 THEN 800
    WHEN last_payment_amount > monthly_installment THEN 650
    WHEN last_payment_amount = monthly_installment THEN 500
    WHEN last_payment_amount >= monthly_installment * 0.5 THEN 250
    WHEN last_payment_amount < monthly_installment * 0.5 THEN 100 ELSE 0 END AS last_payment_pts,
  CASE WHEN payment_completion_ratio >= 1 THEN 800 WHEN payment_completion_ratio >= 0.5 THEN 650
    WHEN payment_completion_ratio > 0 THEN 500 ELSE 0 END AS total_payment_pts,
  {_counter_points('delinq_2yrs', 0)} AS delinq_pts,
  {_counter_points('public_records', 100)} AS public_records_pts,
  {_counter_points('public_bankruptcies', 0)} AS bankruptcy_pts,
  {_counter_points('inquiries_last_6months', 0)} AS inquiry_pts,
  CASE loan_status_category WHEN 'FULLY_PAID' THEN 800 WHEN 'CURRENT' THEN 500 WHEN 'GRACE_PERIOD' THEN 250
    WHEN 'LATE' THEN 100 ELSE 0 END AS loan_status_pts,
  CASE upper(home_ownership) WHEN 'OWN' THEN 800 WHEN 'MORTGAGE' THEN 500 WHEN 'RENT' THEN 250
    ELSE 100 END AS home_ownership_pts,
  CASE WHEN funded_amount <= total_high_credit_limit * CAST(0.1 AS DOUBLE) THEN 800
    WHEN funded_amount <= total_high_credit_limit * CAST(0.3 AS DOUBLE) THEN 650
    WHEN funded_amount <= total_high_credit_limit * CAST(0.5 AS DOUBLE) THEN 500
    WHEN funded_amount <= total_high_credit_limit * CAST(0.7 AS DOUBLE) THEN 250
    ELSE 0 END AS credit_utilization_pts,
  CASE grade WHEN 'A' THEN 800 WHEN 'B' THEN 650 WHEN 'C' THEN 500 WHEN 'D' THEN 250 WHEN 'E' THEN 100
    ELSE 0 END AS grade_pts
FROM joined""",
    "subscores": """SELECT *,
  round((last_payment_pts + total_payment_pts) * CAST(0.2 AS DOUBLE), 2) AS payment_history_score,
  round((delinq_pts + public_records_pts + bankruptcy_pts + inquiry_pts) * CAST(0.45 AS DOUBLE), 2)
    AS default_history_score,
  round((loan_status_pts + home_ownership_pts + credit_utilization_pts + grade_pts)
    * CAST(0.35 AS DOUBLE), 2) AS financial_health_score
FROM points""",
    "totals": """SELECT *,
  round(payment_history_score + default_history_score + financial_health_score, 2) AS credit_risk_score
FROM subscores""",
    "graded": """SELECT *, CASE WHEN credit_risk_score > 2500 THEN 'A' WHEN credit_risk_score > 2000 THEN 'B'
  WHEN credit_risk_score > 1500 THEN 'C' WHEN credit_risk_score > 1000 THEN 'D'
  WHEN credit_risk_score > 750 THEN 'E' ELSE 'F' END AS credit_risk_grade FROM totals""",
    "scores": """SELECT member_id, loan_id, grade, annual_income, income_bracket, address_state,
  address_region, home_ownership, loan_amount, loan_status_category, interest_rate, interest_rate_band,
  payment_history_score, default_history_score, financial_health_score, credit_risk_score,
  credit_risk_grade FROM graded""",
    # version history of the customer table
    "first_load": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "second_load": """SELECT
  CASE WHEN c_custkey % 11 = 0 THEN c_custkey + 10000000 ELSE c_custkey END AS c_custkey, c_name, c_nationkey,
  CASE WHEN c_custkey % 5 = 0 THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM first_load""",
    "third_load": """SELECT c_custkey, concat(c_name, ' renamed') AS c_name, c_nationkey, c_acctbal,
  c_mktsegment FROM first_load""",
    # every load as one stream of observations; a version starts where a tracked value changes
    "observed": """SELECT *, DATE '2024-01-01' AS day FROM first_load
UNION ALL SELECT *, DATE '2024-06-01' FROM second_load
UNION ALL SELECT *, DATE '2024-09-01' FROM third_load""",
    "starts": """SELECT * FROM (SELECT *, lag(day) OVER w AS prev_day, lag(c_acctbal) OVER w AS prev_bal,
  lag(c_mktsegment) OVER w AS prev_seg FROM observed WINDOW w AS (PARTITION BY c_custkey ORDER BY day)) t
WHERE prev_day IS NULL OR c_acctbal IS DISTINCT FROM prev_bal OR c_mktsegment IS DISTINCT FROM prev_seg""",
    "versions": """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, day AS effective_date,
  coalesce(lead(day) OVER (PARTITION BY c_custkey ORDER BY day), DATE '9999-12-31') AS end_date,
  lead(day) OVER (PARTITION BY c_custkey ORDER BY day) IS NULL AS is_current FROM starts""",
    "batch": """SELECT * REPLACE (CASE WHEN loan_status IS NULL THEN 'R' || id ELSE id END AS id) FROM bronze""",
}

# A CSV scan reads an empty text as null.
CTES["parsed"] = "SELECT * REPLACE ({}) FROM raw".format(
    ", ".join(f"nullif({quoted(n)}, '') AS {quoted(n)}" for n in RAW_COLUMNS if n in TEXT_COLUMNS)
)
CTES["parsed_bronze"] = CTES["bronze"].replace("FROM raw", "FROM parsed")


def _again(suffix: str, raw: str) -> dict[str, str]:
    """The same expressions under other names, over other raw records."""

    def renamed(sql: str) -> str:
        return re.sub(r"\b(FROM|JOIN) (\w+)", lambda m: f"{m[1]} {m[2]}{suffix if m[2] in base else ''}", sql)

    base = dict(CTES)
    return {f"{name}{suffix}": renamed(sql) for name, sql in base.items() if name != "raw"} | {f"raw{suffix}": raw}


# Two loads: half of the records, and all of them with another limit or home for some. The early load
# of the run by member parts holds the loans with some last digits of the id.
_LOADS = {
    "_one": "SELECT * FROM raw WHERE CAST(url AS BIGINT) % 2 = 0",
    "_two": """SELECT * REPLACE (
  CASE WHEN CAST(url AS BIGINT) % 4 = 1 THEN tot_hi_cred_lim + 7 ELSE tot_hi_cred_lim END AS tot_hi_cred_lim,
  CASE WHEN addr_state = 'IL' THEN 'MOVED' ELSE home_ownership END AS home_ownership) FROM raw""",
    "_early": "SELECT * FROM raw WHERE right(id, 1) IN ('0', '2', '4', '6', '8')",
}
for _copies in [_again(suffix, raw) for suffix, raw in _LOADS.items()]:
    _raw = {name: sql for name, sql in _copies.items() if name.startswith("raw_")}
    CTES = {"raw": CTES["raw"], **_raw, **CTES, **_copies}
_CHANGED = " OR ".join(
    f"a.{name} IS DISTINCT FROM b.{name}"
    for name in (
        "emp_title", "home_ownership", "annual_income", "address_state", "address_zipcode", "grade", "sub_grade",
        "verification_status", "total_high_credit_limit", "application_type", "joint_annual_income",
        "verification_status_joint",
    )
)


def _versions(one: str, two: str) -> str:
    """The customers of a first load, and what a second one closes and opens."""
    return f"""SELECT a.* REPLACE (CASE WHEN b.member_id IS NOT NULL AND ({_CHANGED}) THEN DATE '2024-06-01'
  ELSE a.end_date END AS end_date, b.member_id IS NULL OR NOT ({_CHANGED}) AS is_current)
FROM {one} a LEFT JOIN {two} b ON a.member_id = b.member_id
UNION ALL SELECT b.* REPLACE (DATE '2024-06-01' AS effective_date)
FROM {two} b LEFT JOIN {one} a ON a.member_id = b.member_id
WHERE a.member_id IS NULL OR {_CHANGED}"""


def _needed(sql: str) -> list[str]:
    """Names of the expressions a query refers to, directly or not, in definition order."""
    found: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"\b(?:FROM|JOIN) (\w+)", todo.pop()))
        for name in words & set(CTES) - found:
            found.add(name)
            todo.append(CTES[name])
    return [name for name in CTES if name in found]


def _query(sql: str) -> str:
    parts = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name]})" for name in _needed(sql))
    return f"WITH {parts}\n{sql}" if parts else sql


def _counts(*named: tuple[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS table_name, count(*) AS row_count FROM {table}" for label, table in named
    )


def _key_line(label: str, table: str, key: str) -> str:
    return (
        f"SELECT '{label}' AS table_name, count(*) AS row_count, "
        f"CAST(count(*) - count({key}) AS BIGINT) AS null_keys, "
        f"CAST(count(*) - count(DISTINCT {key}) AS BIGINT) AS duplicate_keys FROM {table}"
    )


def _null_line(column: str, limit: float) -> str:
    share = f"avg(CASE WHEN {column} IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"
    return (
        f"SELECT '{column}' AS column_name, {share} AS null_fraction, CAST({limit} AS DOUBLE) AS limit_fraction, "
        f"{share} <= CAST({limit} AS DOUBLE) AS within_limit FROM raw"
    )


def _range_line(column: str, low: float, high: float) -> str:
    return (
        f"SELECT '{column}' AS column_name, CAST({low} AS DOUBLE) AS low_limit, "
        f"CAST({high} AS DOUBLE) AS high_limit, CAST(count(*) FILTER (WHERE {column} < {low} OR "
        f"{column} > {high}) AS BIGINT) AS violations FROM raw"
    )


_TABLES = (
    ("raw_loan_data", "bronze"),
    ("dim_customers", "customers"),
    ("fact_loans", "loans"),
    ("fact_loan_repayments", "repayments"),
    ("dim_loan_defaulters", "defaulters"),
    ("credit_risk_scores", "scores"),
)

_SQL = {
    "bronze_audit": "SELECT id, url, 'orders' AS _source_file, '20240101_020000' AS _batch_id FROM raw",
    "bronze_load": (
        f"SELECT {', '.join(quoted(n) for n in RAW_COLUMNS)}, 'orders' AS _source_file, "
        "'20240101_020000' AS _batch_id FROM bronze"
    ),
    "preview_top20": (
        "SELECT loan_id, credit_risk_score, credit_risk_grade FROM scores "
        "ORDER BY credit_risk_score DESC, loan_id LIMIT 20"
    ),
    "table_summary": _counts(*_TABLES),
    "filter_garbage": (
        "SELECT url, loan_amnt, grade, annual_inc FROM raw WHERE loan_amnt IS NOT NULL "
        "AND grade IS NOT NULL AND annual_inc IS NOT NULL"
    ),
    "extract_customers": "SELECT * FROM x_customers",
    "extract_loans": "SELECT * FROM x_loans",
    "extract_repayments": "SELECT * FROM x_repayments",
    "extract_defaulters": "SELECT * FROM x_defaulters",
    "member_id": f"SELECT url, {MEMBER_HASH} AS member_id FROM raw",
    "dedup_by_key": (
        "SELECT l_partkey, l_orderkey, l_linenumber, l_quantity FROM lineitem QUALIFY row_number() OVER "
        "(PARTITION BY l_partkey ORDER BY l_shipdate ASC NULLS FIRST, l_orderkey ASC NULLS FIRST, "
        "l_linenumber ASC NULLS FIRST, l_quantity ASC NULLS FIRST) = 1"
    ),
    "dedup_customers": "SELECT * FROM d_customers",
    "dedup_loans": "SELECT * FROM d_loans",
    "dedup_repayments": "SELECT * FROM d_repayments",
    "dedup_defaulters": "SELECT * FROM d_defaulters",
    "scd2_initial": (
        "SELECT *, DATE '2024-01-01' AS effective_date, DATE '9999-12-31' AS end_date, true AS is_current "
        "FROM first_load"
    ),
    "scd2_merge": "SELECT * FROM versions",
    "emp_length_imputed": "SELECT member_id, emp_length FROM customers",
    "emp_category": f"SELECT url, emp_title, {_job_category()} AS emp_category FROM bronze",
    "state_validated": f"SELECT url, addr_state, {_valid_state('addr_state')} AS valid_state FROM bronze",
    "state_region": f"SELECT url, addr_state, {_region('addr_state')} AS region FROM bronze",
    "state_enriched": (
        f"SELECT member_id, {_valid_state('addr_state')} AS address_state, "
        f"{_region('addr_state')} AS address_region FROM bronze"
    ),
    "income_capped": (
        f"SELECT member_id, {CAPPED} AS annual_income, "
        "coalesce(annual_income > 10000000, false) AS income_outlier_flag FROM x_customers"
    ),
    "income_bracket": f"SELECT url, annual_inc, {_bracket('annual_inc')} AS income_bracket FROM bronze",
    "customer_features": (
        f"SELECT member_id, annual_income, {_bracket('annual_income')} AS income_bracket, "
        f"{_ratio('annual_income', 'total_high_credit_limit')} AS credit_utilization_ratio FROM x_customers"
    ),
    "loan_dates": (
        f"SELECT loan_id, {ISSUED} AS issue_date, CAST(year({ISSUED}) AS INTEGER) AS issue_year, "
        f"CAST(month({ISSUED}) AS INTEGER) AS issue_month, strftime({ISSUED}, '%Y-%m') AS vintage_month "
        "FROM x_loans"
    ),
    "payment_dates": (
        f"SELECT loan_id, {PAID} AS last_payment_date, {_month('next_payment_date_raw')} AS next_payment_date, "
        f"{ISSUED} AS issue_date FROM x_repayments"
    ),
    "loan_term": f"SELECT loan_id, {_first_number('term')} AS loan_term_months FROM x_loans",
    "loan_status_category": (
        f"SELECT url, loan_status, {STATUS_CATEGORY} AS loan_status_category FROM bronze"
    ),
    "interest_rate_band": f"SELECT url, int_rate, {_rate_band('int_rate')} AS interest_rate_band FROM bronze",
    "loan_features": (
        f"SELECT loan_id, {_rate_band('interest_rate')} AS interest_rate_band, "
        f"{_ratio('loan_amount', 'annual_income')} AS loan_to_income_ratio, "
        "loan_amount - funded_amount AS funded_amount_gap, "
        f"{_ratio('funded_amount', 'loan_amount')} AS funded_pct FROM x_loans"
    ),
    "repayment_features": (
        f"SELECT loan_id, {_ratio('total_payment_received', 'loan_amount')} AS payment_completion_ratio, "
        "coalesce(total_late_fee_received > 0, false) AS late_payment_flag, "
        f"coalesce({_ratio('recoveries', 'outstanding_principal')}, CAST(0 AS DOUBLE)) AS recovery_rate, "
        f"CAST((year({PAID}) - year({ISSUED})) * 12 + month({PAID}) - month({ISSUED}) AS INTEGER) "
        "AS months_on_books, "
        f"{_ratio('last_payment_amount', 'monthly_installment')} AS payment_to_installment_ratio "
        "FROM x_repayments"
    ),
    "delinquency_aging": (
        f"SELECT member_id, months_since_last_delinq, {AGING} AS delinquency_aging FROM x_defaulters"
    ),
    "risk_tier": f"SELECT member_id, {TIER} AS default_risk_tier FROM x_defaulters",
    "compound_risk": f"SELECT member_id, {COMPOUND} AS compound_risk_indicator FROM x_defaulters",
    "join_loans_customers": (
        "SELECT l.loan_id, l.member_id, l.loan_amount, c.annual_income, c.grade, c.emp_category "
        "FROM loans l JOIN customers c ON l.member_id = c.member_id WHERE c.is_current"
    ),
    "join_repayments": (
        "SELECT l.loan_id, l.member_id, l.loan_amount, r.monthly_installment, r.total_payment_received "
        "FROM loans l JOIN repayments r ON l.loan_id = r.loan_id AND l.member_id = r.member_id"
    ),
    "join_defaulters_left": (
        "SELECT l.loan_id, l.member_id, l.loan_amount, d.delinq_2yrs, d.default_risk_tier "
        "FROM loans l LEFT JOIN defaulters d ON l.member_id = d.member_id"
    ),
    "gold_join": "SELECT * FROM joined",
    "gold_join_counted": "SELECT * FROM joined",
    "score_payment": "SELECT loan_id, last_payment_pts, total_payment_pts FROM points",
    "score_default": (
        "SELECT loan_id, delinq_pts, public_records_pts, bankruptcy_pts, inquiry_pts FROM points"
    ),
    "score_financial": (
        "SELECT loan_id, loan_status_pts, home_ownership_pts, credit_utilization_pts, grade_pts FROM points"
    ),
    "composite_score": (
        "SELECT loan_id, payment_history_score, default_history_score, financial_health_score, "
        "credit_risk_score FROM totals"
    ),
    "credit_grade": "SELECT loan_id, credit_risk_grade FROM graded",
    "gold_scores": "SELECT * FROM scores",
    "grade_distribution": (
        "SELECT credit_risk_grade, count(*) AS loan_count FROM scores GROUP BY 1 ORDER BY 1"
    ),
    "emp_length_mean": "SELECT m AS mean_years FROM mean_years",
    "row_counts": _counts(("raw", "raw"), ("bronze", "bronze")),
    "dq_bronze": (
        "SELECT count(*) AS row_count, CAST(count(*) - count(loan_amnt) AS BIGINT) AS loan_amnt_nulls, "
        "CAST(count(*) - count(grade) AS BIGINT) AS grade_nulls, "
        "CAST(count(*) - count(member_id) AS BIGINT) AS member_id_nulls FROM bronze"
    ),
    "dq_silver": " UNION ALL ".join(
        _key_line(label, table, "member_id" if label.startswith("dim") else "loan_id")
        for label, table in _TABLES[1:5]
    ),
    "dq_null_fraction": " UNION ALL ".join(
        _null_line(column, limit)
        for column, limit in (
            ("id", 0.0), ("url", 0.0), ("loan_amnt", 0.05), ("annual_inc", 0.05), ("grade", 0.05),
            ("title", 0.3), ("emp_length", 0.3), ("mths_since_last_delinq", 0.3),
        )
    ),
    "dq_row_tolerance": (
        "SELECT s.n AS source_rows, t.n AS target_rows, "
        "CAST(abs(s.n - t.n) AS DOUBLE) / CAST(s.n AS DOUBLE) AS gap_fraction, "
        "abs(s.n - t.n) <= s.n * CAST(0.02 AS DOUBLE) AS within_tolerance "
        "FROM (SELECT count(*) AS n FROM raw) s, (SELECT count(*) AS n FROM bronze) t"
    ),
    "dq_range": " UNION ALL ".join(
        _range_line(*line)
        for line in (
            ("annual_inc", 0.0, 10000000.0), ("loan_amnt", 0.0, 100000.0), ("int_rate", 0.0, 35.0),
        )
    ),
    "dim_customers": "SELECT * FROM customers",
    "fact_loans": "SELECT * FROM loans",
    "fact_loan_repayments": "SELECT * FROM repayments",
    "dim_loan_defaulters": "SELECT * FROM defaulters",
    "full_run": "SELECT * FROM scores",
    # The loads of the append run make up all records, so its Gold is that of one load.
    "append_run": "SELECT * FROM scores",
    "load_history": _versions("customers_one", "customers_two"),
    "append_history": "SELECT * FROM scores_two",
    "append_by_parts": "SELECT * FROM scores",
    "history_by_parts": _versions("customers_early", "customers"),
    "member_loan_counts": "SELECT member_id, count(*) AS row_count FROM loans GROUP BY 1",
    "raw_csv_load": (
        f"SELECT {', '.join(quoted(n) for n in RAW_COLUMNS)}, 'orders' AS _source_file, "
        "'20240101_020000' AS _batch_id FROM parsed_bronze"
    ),
    "incremental_append": (
        "SELECT id, url, loan_amnt, loan_status FROM bronze UNION ALL "
        "SELECT id, url, loan_amnt, loan_status FROM batch b WHERE NOT EXISTS "
        "(SELECT 1 FROM bronze h WHERE h.id = b.id)"
    ),
    "vintage_summary": (
        "SELECT l.vintage_month, count(*) AS loan_count, sum(l.loan_amount) AS total_loan_amount, "
        "avg(s.credit_risk_score) AS avg_credit_risk_score, "
        "avg(CASE WHEN l.loan_status_category = 'CHARGED_OFF' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) "
        "AS charged_off_share FROM loans l LEFT JOIN scores s ON l.loan_id = s.loan_id GROUP BY 1"
    ),
    "region_summary": (
        "SELECT address_region, count(*) AS loan_count, count(DISTINCT member_id) AS member_count, "
        "sum(loan_amount) AS total_loan_amount, avg(annual_income) AS avg_annual_income, "
        "avg(credit_risk_score) AS avg_credit_risk_score FROM scores GROUP BY 1"
    ),
}

ORACLES = {name: _query(sql) for name, sql in _SQL.items()}

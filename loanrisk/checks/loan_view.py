"""Raw loan records derived from the `orders` table, one per order; the borrower is the customer.

The given tables hold no loans. Every raw column is an integer-arithmetic expression over the order
key `k`, the customer key `c` and the order date `d`, written so that Spark and DuckDB agree.
`{STR}` is the string type and `{MON}` the month text of the date in the dialect at hand. Raw
columns without an expression are typed nulls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loanrisk.sources.raw_schema import RAW_COLUMNS, TEXT_COLUMNS

#: Tasks that derive the records, for each core.
TASKS_PER_CORE = 3

# The expressions that define the test records.
LOAN_EXPRESSIONS = {
    "id": (
        "CASE WHEN k % 997 = 0 THEN NULL WHEN k % 50 = 49 THEN CAST(k - 1 AS {STR}) ELSE "
        "CAST(k AS {STR}) END"
    ),
    "member_id": "CAST(NULL AS {STR})",
    "loan_amnt": (
        "CASE WHEN k % 501 = 7 THEN NULL ELSE CAST(1000 + (k*37 % 390)*100 AS DOUBLE) END"
    ),
    "funded_amnt": (
        "CAST(1000 + (k*37 % 390)*100 - CASE WHEN k % 10 = 0 THEN 500 ELSE 0 END AS DOUBLE)"
    ),
    "term": "CASE WHEN k % 2 = 0 THEN ' 36 months' ELSE ' 60 months' END",
    "int_rate": "CAST(5 + k % 26 AS DOUBLE)",
    "installment": "CAST(50 + k % 900 AS DOUBLE)",
    "grade": "substr('ABCDEFG', CAST(c % 7 AS INT) + 1, 1)",
    "sub_grade": (
        "concat(substr('ABCDEFG', CAST(c % 7 AS INT) + 1, 1), CAST(c % 5 + 1 AS {STR}))"
    ),
    "emp_title": (
        "CASE c % 15 WHEN 0 THEN 'Truck Driver' WHEN 1 THEN ' Registered Nurse ' WHEN 2 THEN "
        "'TEACHER' WHEN 3 THEN 'Software Engineer' WHEN 4 THEN 'Accountant' WHEN 5 THEN "
        "'Store Manager' WHEN 6 THEN 'Sales Rep' WHEN 7 THEN 'Paralegal' WHEN 8 THEN "
        "'Carpenter' WHEN 9 THEN 'Police Officer' WHEN 10 THEN 'Bartender' WHEN 11 THEN "
        "'Artist' WHEN 12 THEN NULL WHEN 13 THEN 'IT Support' ELSE 'Credit Analyst' END"
    ),
    "emp_length": (
        "CASE c % 6 WHEN 0 THEN '10+ years' WHEN 1 THEN '< 1 year' WHEN 2 THEN '3 years' WHEN "
        "3 THEN 'n/a' WHEN 4 THEN NULL ELSE '7 years' END"
    ),
    "home_ownership": (
        "CASE c % 5 WHEN 0 THEN 'OWN' WHEN 1 THEN 'MORTGAGE' WHEN 2 THEN 'rent' WHEN 3 THEN "
        "'ANY' ELSE NULL END"
    ),
    "annual_inc": (
        "CASE WHEN c % 211 = 0 THEN 12000000.0 WHEN c % 223 = 0 THEN NULL ELSE CAST(12000 + "
        "(c*991 % 260)*1000 AS DOUBLE) END"
    ),
    "verification_status": (
        "CASE c % 3 WHEN 0 THEN 'Verified' WHEN 1 THEN 'Not Verified' ELSE 'Source Verified' "
        "END"
    ),
    "issue_d": "{MON}",
    "loan_status": (
        "CASE k % 9 WHEN 0 THEN 'Fully Paid' WHEN 1 THEN 'Current' WHEN 2 THEN 'In Grace "
        "Period' WHEN 3 THEN 'Late (31-120 days)' WHEN 4 THEN 'Charged Off' WHEN 5 THEN "
        "'Default' WHEN 6 THEN 'Does not meet the credit policy. Status:Fully Paid' WHEN 7 "
        "THEN NULL ELSE 'Issued' END"
    ),
    "zip_code": "concat(CAST(100 + c % 900 AS {STR}), 'xx')",
    "addr_state": (
        "CASE c % 8 WHEN 0 THEN 'CA' WHEN 1 THEN ' ny ' WHEN 2 THEN 'tx' WHEN 3 THEN 'IL' "
        "WHEN 4 THEN 'XY' WHEN 5 THEN NULL WHEN 6 THEN '' ELSE 'GA' END"
    ),
    "delinq_2yrs": (
        "CASE WHEN c % 4 = 0 OR c % 35 = 0 THEN NULL ELSE CAST((c + k) % 8 AS DOUBLE) END"
    ),
    "pub_rec": "CASE WHEN c % 35 = 0 THEN 0.0 ELSE CAST(k % 7 AS DOUBLE) END",
    "pub_rec_bankruptcies": "CASE WHEN c % 35 = 0 THEN 0.0 ELSE CAST(k % 6 AS DOUBLE) END",
    "inq_last_6mths": "CASE WHEN c % 35 = 0 THEN 0.0 ELSE CAST(k % 8 AS DOUBLE) END",
    "mths_since_last_delinq": "CASE WHEN k % 3 = 0 THEN NULL ELSE CAST(k % 90 AS DOUBLE) END",
    "tot_hi_cred_lim": "CASE WHEN k % 4 = 0 THEN 0.0 ELSE CAST(5000 + (c + k) % 200000 AS DOUBLE) END",
    "total_pymnt": (
        "CAST((k*37 % 390)*40 + k % 1000 + CASE WHEN k % 100 = 99 THEN 100000 WHEN k % 23 = 0 "
        "THEN 60000 ELSE 0 END AS DOUBLE)"
    ),
    "last_pymnt_amnt": (
        "CASE k % 6 WHEN 0 THEN CAST(50 + k % 900 AS DOUBLE)*2 WHEN 1 THEN CAST(50 + k % 900 "
        "AS DOUBLE)*1.25 WHEN 2 THEN CAST(50 + k % 900 AS DOUBLE) WHEN 3 THEN CAST(50 + k % "
        "900 AS DOUBLE)*0.75 WHEN 4 THEN 1.0 ELSE NULL END"
    ),
    "url": "CAST(k AS {STR})",
    "total_rec_late_fee": "CAST(k % 5 * 10 AS DOUBLE)",
    "out_prncp": "CASE WHEN k % 4 = 0 THEN 0.0 ELSE CAST(100 + k % 5000 AS DOUBLE) END",
    "recoveries": "CASE WHEN k % 7 = 0 THEN NULL ELSE CAST(k % 400 AS DOUBLE) END",
    "last_pymnt_d": (
        "CASE WHEN k % 11 = 0 THEN 'bad' WHEN k % 13 = 0 THEN NULL ELSE "
        "concat(substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(k % 12 AS INT)*3 + 1, 3), "
        "'-', CAST(1996 + k % 8 AS {STR})) END"
    ),
    "acc_now_delinq": "CAST(CASE WHEN k % 19 = 0 THEN 1 ELSE 0 END AS DOUBLE)",
    "collections_12_mths_ex_med": "CAST(k % 3 AS DOUBLE)",
    "chargeoff_within_12_mths": "CAST(CASE WHEN k % 17 = 0 THEN 1 ELSE 0 END AS DOUBLE)",
    "tax_liens": "CAST(k % 2 AS DOUBLE)",
    "funded_amnt_inv": (
        "CAST(1000 + (k*37 % 390)*100 - CASE WHEN k % 10 = 0 THEN 500 ELSE 0 END AS DOUBLE)"
    ),
    "purpose": (
        "CASE k % 3 WHEN 0 THEN 'debt_consolidation' WHEN 1 THEN 'small_business' ELSE 'car' "
        "END"
    ),
    "title": "CASE WHEN k % 5 = 0 THEN NULL ELSE 'Loan' END",
    "application_type": "CASE WHEN c % 10 = 0 THEN 'Joint App' ELSE 'Individual' END",
    "annual_inc_joint": "CASE WHEN c % 10 = 0 THEN CAST(90000 + c AS DOUBLE) ELSE NULL END",
    "verification_status_joint": "CASE WHEN c % 10 = 0 THEN 'Verified' ELSE NULL END",
    "total_rec_prncp": "CAST((k*37 % 390)*30 AS DOUBLE)",
    "total_rec_int": "CAST((k*37 % 390)*10 AS DOUBLE)",
    "collection_recovery_fee": "CAST(k % 40 AS DOUBLE)",
    "next_pymnt_d": "CASE WHEN k % 2 = 0 THEN NULL ELSE 'Jan-2005' END",
    "delinq_amnt": "CASE WHEN k % 19 = 0 THEN CAST(k % 1000 AS DOUBLE) ELSE 0.0 END",
}


def _select_list(string_type: str, month_text: str) -> list[str]:
    expressions = []
    for name in RAW_COLUMNS:
        kind = string_type if name in TEXT_COLUMNS else "DOUBLE"
        template = LOAN_EXPRESSIONS.get(name, "NULL")
        expression = template.replace("{STR}", string_type).replace("{MON}", month_text)
        expressions.append(f"CAST({expression} AS {kind}) AS {quoted(name)}")
    return expressions


def quoted(name: str) -> str:
    """`desc` is a reserved word in SQL."""
    return f'"{name}"' if name == "desc" else name


def raw_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "o_orderkey AS k", "o_custkey AS c", "o_orderdate AS d"
    )
    # Three narrow columns become 118, and a scan has no more tasks than row groups: keys are spread over
    # tasks first, in their order, which stored columns are smaller for.
    orders = orders.repartitionByRange(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, "k")
    expressions = _select_list("STRING", "date_format(d, 'MMM-yyyy')")
    return orders.selectExpr(*[e.replace('"', "`") for e in expressions])


def raw_loans_sql() -> str:
    """The same records as a DuckDB query."""
    columns = ",\n  ".join(_select_list("VARCHAR", "strftime(d, '%b-%Y')"))
    return (
        f"SELECT {columns}\nFROM (SELECT o_orderkey AS k, o_custkey AS c, o_orderdate AS d FROM orders) t"
    )

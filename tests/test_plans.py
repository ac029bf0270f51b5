"""What the pipelines produce, and the shape of their physical plans."""

import re
from concurrent.futures import ThreadPoolExecutor
from datetime import date

import pytest
from pyspark.sql import functions as F

from loanrisk import config as c
from loanrisk.checks.loan_view import raw_loans
from loanrisk.checks.queries import QUERIES
from loanrisk.operators import quality
from loanrisk.operators.append import new_rows
from loanrisk.plans import bronze, full_run, gold, reports, silver
from loanrisk.sources.raw_files import read_raw_csv
from loanrisk.sources.raw_schema import RAW_COLUMNS
from loanrisk.sources.tables import read_table, table_exists

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"

# The columns of every stored table, in order.
COLUMNS = {
    c.RAW_LOANS: [*RAW_COLUMNS, "_ingested_at", "_source_file", "_batch_id"],
    c.DIM_CUSTOMERS: """member_id emp_title emp_length home_ownership annual_income address_state
        address_zipcode address_country grade sub_grade verification_status total_high_credit_limit
        application_type joint_annual_income verification_status_joint emp_category address_region
        income_outlier_flag income_bracket credit_utilization_ratio effective_date end_date is_current
        _transformed_at""".split(),
    c.FACT_LOANS: """loan_id member_id loan_amount funded_amount investor_funded_amount interest_rate
        monthly_installment loan_status loan_purpose loan_title issue_date issue_year issue_month
        vintage_month loan_term_months loan_status_category interest_rate_band loan_to_income_ratio
        funded_amount_gap funded_pct _transformed_at""".split(),
    c.FACT_REPAYMENTS: """loan_id member_id monthly_installment total_principal_received
        total_interest_received total_late_fee_received total_payment_received last_payment_amount
        recoveries collection_recovery_fee outstanding_principal last_payment_date next_payment_date
        payment_completion_ratio late_payment_flag recovery_rate months_on_books
        payment_to_installment_ratio _transformed_at""".split(),
    c.DIM_DEFAULTERS: """member_id delinq_2yrs delinq_amount months_since_last_delinq public_records
        public_bankruptcies inquiries_last_6months accounts_now_delinquent collections_12months
        chargeoffs_12months tax_liens delinquency_aging default_risk_tier compound_risk_indicator
        _transformed_at""".split(),
    c.RISK_SCORES: [*gold.SCORE_COLUMNS, "_scored_at"],
}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    layout = c.TableLayout(path=str(tmp_path_factory.mktemp("tables")))
    # padded, the tie-breaking text sorts like the number it holds, as in the expected counts
    raw = raw_loans(spark, MEDIUM).withColumn("url", F.lpad("url", 12, "0"))
    report = full_run.full_run(spark, raw, layout, load_date=date(2024, 1, 1))
    return layout, report, full_run.stored_tables(spark, layout)


def silver_tables(stored):
    names = (c.DIM_CUSTOMERS, c.FACT_LOANS, c.FACT_REPAYMENTS, c.DIM_DEFAULTERS)
    return [stored[2][name] for name in names]


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def content(df):
    """Row count and an order-free digest of all values."""
    digest = F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))
    return df.agg(F.count(F.lit(1)).alias("rows"), digest.alias("digest")).first().asDict()


# ---- results -----------------------------------------------------------------------------------


def test_stored_columns(stored):
    assert {name: df.columns for name, df in stored[2].items()} == COLUMNS


def test_stored_counts(stored):
    """Counts worked out beforehand for this input; see FIXTURES.md."""
    _, report, tables = stored
    counts = {name: df.count() for name, df in tables.items()}
    assert counts == {
        c.RAW_LOANS: 14_922, c.DIM_CUSTOMERS: 1_494, c.FACT_LOANS: counts[c.FACT_LOANS],
        c.FACT_REPAYMENTS: counts[c.FACT_LOANS], c.DIM_DEFAULTERS: 1_494, c.RISK_SCORES: 14_584,
    }
    assert counts[c.FACT_LOANS] - counts[c.RISK_SCORES] == 23
    assert report.rows == {**counts, "raw": 15_000, "garbage": 78}
    assert set(report.seconds) == {"bronze", "silver", "gold"}


def test_grades(stored):
    found = {tuple(r) for r in reports.grade_distribution(stored[2][c.RISK_SCORES]).collect()}
    assert found == {("A", 48), ("B", 399), ("C", 746), ("D", 5011), ("E", 4186), ("F", 4194)}


def test_scores_stay_in_range(stored):
    low, high = stored[2][c.RISK_SCORES].agg(
        F.min("credit_risk_score"), F.max("credit_risk_score")
    ).first()
    assert 80.0 <= low <= high <= 2880.0


def test_stored_tables_pass_the_checks(stored):
    tables = stored[2]
    keys = quality.key_report({name: (tables[name], key) for name, key in c.TABLE_KEY.items()})
    quality.require_filled(keys)
    assert {r.duplicate_keys for r in keys.collect()} == {0}
    quality.require_filled(quality.critical_nulls(tables[c.RAW_LOANS], ["loan_amnt", "grade", "member_id"]))


def test_every_band_occurs(stored):
    seen = stored[2][c.DIM_DEFAULTERS]
    assert {r[0] for r in seen.select("default_risk_tier").distinct().collect()} == {
        "VERY_HIGH", "HIGH", "MODERATE", "LOW",
    }
    assert seen.select("delinquency_aging").distinct().count() == 5


def test_hot_members_change_nothing(stored):
    tables = silver_tables(stored)
    plain = gold.credit_risk_scores(*tables).drop("_scored_at")
    sliced = gold.credit_risk_scores(*tables, skew=c.SkewConfig(slice_rows=4)).drop("_scored_at")
    assert content(plain) == content(sliced)


def test_silver_is_the_same_under_any_input_order(spark):
    held = bronze.to_bronze(raw_loans(spark, SMALL))
    shuffled = held.orderBy(F.xxhash64("url")).repartition(3)
    for build in (silver.dim_customers, silver.fact_loans, silver.fact_repayments, silver.dim_defaulters):
        for ties in (silver.TIE_BREAKERS, ()):
            one, other = (content(build(b, tie_breakers=ties).drop("_transformed_at")) for b in (held, shuffled))
            assert one == other and one["rows"] > 0


def test_only_current_customers_are_scored(stored):
    customers, loans, repayments, defaulters = silver_tables(stored)
    ended = customers.withColumn("is_current", F.lit(False))
    assert gold.gold_join(ended, loans, repayments, defaulters).isEmpty()


def test_member_without_default_history_scores_as_clean(stored):
    customers, loans, repayments, defaulters = silver_tables(stored)
    joined = gold.gold_join(customers, loans, repayments, defaulters.where("false"))
    points = gold.score_default(joined).select(
        "delinq_pts", "public_records_pts", "bankruptcy_pts", "inquiry_pts"
    ).distinct().collect()
    assert [tuple(p) for p in points] == [(800, 800, 800, 800)]


def test_facts_that_name_different_members_do_not_join(spark):
    loans = spark.createDataFrame(
        [("1", "a", 0.0), ("2", "b", 0.0), ("3", None, 0.0)], "loan_id string, member_id string, monthly_installment double"
    ).withColumn("_transformed_at", F.current_timestamp())
    repayments = spark.createDataFrame(
        [("1", "a", 9.0), ("2", "z", 9.0), ("3", None, 9.0)], "loan_id string, member_id string, monthly_installment double"
    ).withColumn("_transformed_at", F.current_timestamp())
    assert [tuple(r) for r in gold.join_facts(loans, repayments).collect()] == [("1", "a", 9.0)]


def customers_with(spark, *lengths):
    return spark.createDataFrame([(v,) for v in lengths], "emp_length string")


@pytest.mark.parametrize(
    "lengths, filled",
    [
        (["5 years", "10+ years", "< 1 year", None], 5),  # 16 / 3
        (["2 years", "3 years", "n/a"], 2),  # 2.5 goes to the even neighbour
        (["3 years", "4 years", None], 4),
        ([None, "n/a"], 5),
        (["0 years", None], 5),
    ],
)
def test_missing_employment_length(spark, lengths, filled):
    found = silver.with_employment_years(customers_with(spark, *lengths)).collect()
    assert [r.emp_length for r in found if r.emp_length is None] == []
    missing = [r.emp_length for r, raw in zip(found, lengths) if raw in (None, "n/a")]
    assert set(missing) == {filled}


def test_income_cap(spark):
    df = spark.createDataFrame([(120_000.0,), (10_000_000.0,), (10_000_000.01,), (None,)], "annual_income double")
    assert [tuple(r) for r in silver.with_capped_income(df).collect()] == [
        (120_000.0, False), (10_000_000.0, False), (10_000_000.0, True), (None, False),
    ]


def test_counters_that_are_no_ints_become_null(spark):
    raw = raw_loans(spark, SMALL).limit(1).withColumns(
        {"delinq_2yrs": F.lit(float("nan")), "pub_rec": F.lit(1e12), "tax_liens": F.lit(2.9)}
    )
    row = silver.extract_defaulters(raw).first()
    assert (row.delinq_2yrs, row.public_records, row.tax_liens) == (None, None, 2)


# ---- plans -------------------------------------------------------------------------------------


def test_silver_reads_only_its_columns_and_filters_at_the_scan(stored):
    held = stored[2][c.RAW_LOANS]
    query = silver.dim_defaulters(held)._jdf.queryExecution()
    formatted = held.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    read = re.search(r"ReadSchema: struct<([^>]*)", query.explainString(formatted)).group(1)
    assert len(read.split(",")) == 13  # 11 columns and two tie-breakers
    loans = physical(silver.fact_loans(held))
    assert "IsNotNull(id)" in loans
    assert loans.count("Exchange hashpartitioning") == 1
    assert loans.count("WindowGroupLimit") == 2


def test_gold_shuffles_the_facts_once_per_key(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(gold.credit_risk_scores(*silver_tables(stored)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)
    keys = sorted(re.sub(r"#\d+L?", "", e) for e in exchanges)
    # The facts meet by loan and move once to (member, slice), where the two member tables join
    # them; all counts of hot members, and their total, come from one exchange.
    assert [k for k in keys if k != "member_id"] == ["_paid_loan", "loan_id"] + ["member_id, _slice"] * 3
    # Each of the three uses of the list counts members, once for the list and once for the total.
    # They are equal, so that one exchange is run and reused.
    assert keys.count("member_id") == 6, keys
    assert plan.count("SortMergeJoin") == 3
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(is_current,true\)", plan)


def test_stored_counts_spare_gold_a_scan_of_the_loans(spark, stored):
    """The list of hot members is read from the counts written with the loans, and nothing is counted."""
    layout, _, _ = stored
    tables = silver_tables(stored)
    counts = read_table(spark, layout, c.MEMBER_LOANS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counted = gold.gold_join(*tables, member_counts=counts)
        plan = physical(counted)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)
    assert sorted(re.sub(r"#\d+L?", "", k) for k in keys) == ["_paid_loan", "loan_id"] + ["member_id, _slice"] * 3
    folders = re.findall(r"FileScan parquet[^\n]*?/(\w+)\]", plan)
    assert folders.count(c.FACT_LOANS) == 1 and c.MEMBER_LOANS in folders
    # The same rows in slices of one loan, by counts that fit and by counts that are out of date.
    small = c.SkewConfig(slice_rows=1, max_hot_keys=1_000_000)
    old = counts.where("row_count > 1").withColumn("row_count", F.lit(3).cast("long"))
    assert not old.isEmpty()
    plain = gold.gold_join(*tables)
    for config, known in ((small, counts), (small, old), (small, counts.where("false"))):
        sliced = gold.gold_join(*tables, config, member_counts=known)
        assert sliced.exceptAll(plain).isEmpty() and plain.exceptAll(sliced).isEmpty()


def test_stored_counts_are_those_of_the_loans(spark, stored):
    layout, _, tables = stored
    counts = read_table(spark, layout, c.MEMBER_LOANS)
    theirs = tables[c.FACT_LOANS].groupBy("member_id").agg(F.count("*").alias("row_count"))
    assert counts.columns == ["member_id", "row_count"]
    assert counts.exceptAll(theirs).isEmpty() and theirs.exceptAll(counts).isEmpty()


def test_bucketed_facts_join_without_a_shuffle(spark):
    layout = c.TableLayout(bronze="b_bronze", silver="b_silver", gold="b_gold")
    full_run.full_run(spark, raw_loans(spark, SMALL), layout, fact_buckets=4)
    loans, repayments = (read_table(spark, layout, t) for t in (c.FACT_LOANS, c.FACT_REPAYMENTS))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = gold.join_facts(loans, repayments)
        assert "Exchange" not in physical(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert joined.count() == QUERIES["join_repayments"](spark, SMALL).count()


def test_a_failed_load_does_not_block_the_next(spark, tmp_path):
    layout = c.TableLayout(path=str(tmp_path / "lake"))
    raw = raw_loans(spark, SMALL)
    with pytest.raises(quality.QualityError, match="empty"):
        full_run.full_run(spark, raw.where("false"), layout)
    assert not table_exists(spark, layout, c.DIM_CUSTOMERS)
    with ThreadPoolExecutor(1) as pool:
        report = pool.submit(full_run.full_run, spark, raw, layout).result(timeout=300)
    assert report.rows[c.RISK_SCORES] == read_table(spark, layout, c.RISK_SCORES).count() > 0
    with pytest.raises(quality.QualityError, match="null values in member_id"):
        full_run.check_bronze(read_table(spark, layout, c.RAW_LOANS).withColumn("member_id", F.lit(None)))
    tables = full_run.stored_tables(spark, layout)
    silver_only = {name: tables[name] for name in c.TABLE_KEY}
    full_run.check_silver(silver_only)
    with pytest.raises(quality.QualityError, match="null_keys"):
        full_run.check_silver(silver_only | {c.FACT_LOANS: tables[c.FACT_LOANS].withColumn("loan_id", F.lit(None).cast("string"))})


def test_loans_are_stored_by_year(spark, tmp_path):
    layout = c.TableLayout(path=str(tmp_path / "lake"))
    full_run.full_run(spark, raw_loans(spark, SMALL), layout, loan_partitions=["issue_year"])
    plan = physical(read_table(spark, layout, c.FACT_LOANS).where("issue_year = 1995"))
    assert re.search(r"PartitionFilters: \[[^\]]*issue_year", plan)


def test_an_append_parses_the_batch_for_counting_and_for_landing_only(spark, tmp_path, monkeypatch):
    layout = c.TableLayout(path=str(tmp_path / "lake"))
    raw_loans(spark, SMALL).write.csv(str(tmp_path / "csv"), header=True)
    seen = []
    monkeypatch.setattr(full_run, "new_rows", lambda held, batch, **how: seen.append(batch) or new_rows(held, batch, **how))
    raw = read_raw_csv(spark, str(tmp_path / "csv"))
    for _ in range(2):
        full_run.full_run(spark, raw, layout, append=True)
    assert len(seen) == 1 and "FileScan csv" not in physical(new_rows(seen[0], seen[0]))


def test_mean_employment_reads_the_length_alone(stored):
    held = stored[2][c.RAW_LOANS]
    plan = physical(silver.dim_customers(held))
    assert "ReadSchema: struct<emp_length:string>" in plan


def test_append_run_adds_only_new_loans(spark, tmp_path):
    layout = c.TableLayout(path=str(tmp_path))
    raw = raw_loans(spark, SMALL)
    first = full_run.full_run(spark, raw, layout)
    later = raw.withColumn(
        "id", F.when(F.col("grade") == "A", F.concat(F.lit("N"), "id")).otherwise(F.col("id"))
    )
    second = full_run.full_run(spark, later, layout, append=True)
    kept = bronze.filter_garbage(later)
    expected = kept.where("id IS NULL OR grade = 'A'").count()
    assert second.rows[c.RAW_LOANS] == expected > 0
    assert second.rows["garbage"] == first.rows["garbage"]
    assert read_table(spark, layout, c.RAW_LOANS).count() == first.rows[c.RAW_LOANS] + expected

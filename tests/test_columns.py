"""Every band, category and points rule at both sides of each cut-off, and on null."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from loanrisk.config import ScoringConfig
from loanrisk.functions import banding, scoring, text

CFG = ScoringConfig()


def evaluate(spark, rows, schema, column):
    """Value of `column` for each input row, in input order."""
    numbered = [(i, *(row if isinstance(row, tuple) else (row,))) for i, row in enumerate(rows)]
    df = spark.createDataFrame(numbered, f"_i int, {schema}").select("_i", column.alias("_v"))
    return [row["_v"] for row in sorted(df.collect())]


def check(spark, schema, column, cases):
    assert evaluate(spark, [c[0] for c in cases], schema, column) == [c[1] for c in cases]


def test_income_bracket(spark):
    check(spark, "annual_income double", banding.income_bracket(), [
        (29_999.99, "Low"), (30_000.0, "Lower-Middle"), (55_000.0, "Lower-Middle"),
        (59_999.99, "Lower-Middle"), (60_000.0, "Middle"), (99_999.99, "Middle"),
        (100_000.0, "Upper-Middle"), (120_000.0, "Upper-Middle"), (199_999.99, "Upper-Middle"),
        (200_000.0, "High"), (-1.0, "Low"), (None, "Unknown"),
    ])


def test_interest_rate_band(spark):
    check(spark, "interest_rate double", banding.interest_rate_band(), [
        (7.99, "Low"), (8.0, "Medium"), (13.99, "Medium"), (14.0, "High"), (19.99, "High"),
        (20.0, "Very High"), (None, "Unknown"),
    ])


def test_delinquency_aging(spark):
    check(spark, "months_since_last_delinq int", banding.delinquency_aging(), [
        (None, "NEVER_DELINQUENT"), (0, "RECENT"), (11, "RECENT"), (12, "MODERATE"), (35, "MODERATE"),
        (36, "AGED"), (59, "AGED"), (60, "VERY_OLD"), (500, "VERY_OLD"),
    ])


def test_guarded_ratio(spark):
    check(spark, "a double, b double", banding.guarded_ratio("a", "b"), [
        ((120_000.0, 300_000.0), 0.4), ((1800.0, 12e6), 0.0002), ((1.0, 0.0), None),
        ((1.0, -2.0), None), ((1.0, None), None), ((None, 2.0), None), ((2.0, 3.0), 0.6667),
    ])


def test_job_category(spark):
    check(spark, "emp_title string", text.job_category(), [
        ("Software Engineer", "TECHNOLOGY"), ("TRUCK DRIVER", "TRANSPORTATION"),
        ("Teacher", "EDUCATION"), (None, "UNKNOWN"), ("", "OTHER"), ("Artist", "OTHER"),
        ("Hospitality Clerk", "HEALTHCARE"), ("Team Leader", "MANAGEMENT"),
        ("IT", "OTHER"), ("IT ", "OTHER"), ("IT Support", "TECHNOLOGY"), ("VP", "OTHER"),
        ("VP Sales", "MANAGEMENT"), ("Police Officer Manager", "MANAGEMENT"),
        ("police officer", "MILITARY_GOV"), ("GS-12", "MILITARY_GOV"), ("gs 12", "OTHER"),
        ("Paralegal", "LEGAL"), ("Sous Chef", "SERVICE"), ("Bank Teller", "FINANCE"),
        ("Realtor", "SALES_MARKETING"), ("Welder", "CONSTRUCTION"),
        ("Delivery Nurse", "TRANSPORTATION"),
    ])


def test_job_category_equals_plain_substring_search(spark):
    """Brute force over every keyword, alone and inside other text."""
    titles = [form.format(w) for words in text.JOB_KEYWORDS.values() for w in words
              for form in ("{}", "x{}x", "  {} Z ", "Artist {}")]

    def by_hand(title):
        folded = title.strip(" ").lower()
        for name, words in text.JOB_KEYWORDS.items():
            if any(w in folded for w in words):
                return name
        return "OTHER"

    check(spark, "emp_title string", text.job_category(), [(t, by_hand(t)) for t in titles])


def test_fixed_tables_are_complete():
    assert len(text.JOB_KEYWORDS) == 11
    assert sum(map(len, text.JOB_KEYWORDS.values())) == 91
    assert len(text.STATE_REGION) == 51
    assert {r: len(s) for r, s in text.REGION_STATES.items()} == {
        "Northeast": 9, "Midwest": 12, "South": 17, "West": 13,
    }


STATES = [
    ("CA", "CA", "West"), (" ny ", "NY", "Northeast"), ("\ttx\n", "TX", "South"),
    (" il ", "IL", "Midwest"), ("dc", "DC", "South"), ("XY", "NA", None), ("", "NA", None),
    ("   ", "NA", None), (None, "NA", None), ("NA", "NA", None), ("C A", "NA", None),
]


def test_valid_state(spark):
    check(spark, "s string", text.valid_state("s"), [(s, valid) for s, valid, _ in STATES])


def test_state_region(spark):
    check(spark, "s string", text.state_region("s"), [(s, region) for s, _, region in STATES])


def test_loan_status_category(spark):
    check(spark, "loan_status string", text.loan_status_category(), [
        ("Fully Paid", "FULLY_PAID"), (" current ", "CURRENT"), ("In Grace Period", "GRACE_PERIOD"),
        ("Late (31-120 days)", "LATE"), ("Late (16-30 days)", "LATE"), ("Charged Off", "CHARGED_OFF"),
        ("Default", "DEFAULT"), ("Does not meet the credit policy. Status:Fully Paid", "FULLY_PAID"),
        ("Does not meet the credit policy. Status:Charged Off", "CHARGED_OFF"), ("Issued", "OTHER"),
        ("", "OTHER"), (None, "OTHER"),
    ])


def test_first_number(spark):
    check(spark, "t string", text.first_number("t"), [
        ("5 years", 5), ("10+ years", 10), ("< 1 year", 1), ("n/a", None), ("", None), (None, None),
        (" 36 months", 36), ("60 months", 60), ("99999999999", None),
    ])


def test_month_date(spark):
    check(spark, "t string", text.month_date("t"), [
        ("Dec-2015", date(2015, 12, 1)), ("Jan-1999", date(1999, 1, 1)), ("dec-2015", date(2015, 12, 1)),
        ("2015-12-01", None), ("Dec-15", None), ("bad", None), ("", None), (None, None),
    ])


# ---- scoring ---------------------------------------------------------------------------------

COUNTERS = ["delinq_2yrs", "public_records", "public_bankruptcies", "accounts_now_delinquent",
            "chargeoffs_12months", "inquiries_last_6months", "collections_12months", "tax_liens"]
COUNTER_SCHEMA = ", ".join(f"{c} int" for c in COUNTERS)


def counters(**values):
    return tuple(values.get(c) for c in COUNTERS)


def test_risk_tier(spark):
    check(spark, COUNTER_SCHEMA, scoring.risk_tier(), [
        (counters(), "LOW"), (counters(delinq_2yrs=0), "LOW"),
        (counters(delinq_2yrs=6), "VERY_HIGH"), (counters(public_bankruptcies=3), "VERY_HIGH"),
        (counters(accounts_now_delinquent=1), "VERY_HIGH"),
        (counters(delinq_2yrs=5), "HIGH"), (counters(delinq_2yrs=3), "HIGH"),
        (counters(public_records=4), "HIGH"), (counters(chargeoffs_12months=1), "HIGH"),
        (counters(delinq_2yrs=2), "MODERATE"), (counters(delinq_2yrs=1), "MODERATE"),
        (counters(public_records=3), "MODERATE"), (counters(public_records=1), "MODERATE"),
        (counters(inquiries_last_6months=6), "MODERATE"), (counters(inquiries_last_6months=5), "LOW"),
        (counters(public_bankruptcies=2), "LOW"), (counters(tax_liens=9), "LOW"),
    ])


def test_compound_risk_indicator(spark):
    check(spark, COUNTER_SCHEMA, scoring.compound_risk_indicator(), [
        (counters(), 0), (counters(delinq_2yrs=1), 15), (counters(public_records=1), 20),
        (counters(public_bankruptcies=1), 30), (counters(inquiries_last_6months=1), 5),
        (counters(collections_12months=1), 15), (counters(chargeoffs_12months=1), 25),
        (counters(tax_liens=1), 20), (counters(accounts_now_delinquent=1), 0),
        (tuple([2] * 8), 260),
    ])


def test_compound_risk_indicator_is_an_int(spark):
    df = spark.createDataFrame([counters()], COUNTER_SCHEMA).select(scoring.compound_risk_indicator())
    assert df.dtypes[0][1] == "int"


def test_last_payment_points(spark):
    check(spark, "last_payment_amount double, monthly_installment double", scoring.last_payment_points(CFG), [
        ((150.01, 100.0), 800), ((150.0, 100.0), 650), ((100.01, 100.0), 650), ((100.0, 100.0), 500),
        ((99.99, 100.0), 250), ((50.0, 100.0), 250), ((49.99, 100.0), 100), ((None, 100.0), 0),
        ((100.0, None), 0), ((0.0, 0.0), 500),
    ])


def test_total_payment_points(spark):
    check(spark, "payment_completion_ratio double", scoring.total_payment_points(CFG), [
        (1.0, 800), (0.9999, 650), (0.5, 650), (0.4999, 500), (0.0001, 500), (0.0, 0), (-0.1, 0), (None, 0),
    ])


@pytest.mark.parametrize("worst, expected", [(None, 0), (100, 100)])
def test_counter_points(spark, worst, expected):
    check(spark, "n int", scoring.counter_points("n", CFG, worst), [
        (None, 800), (0, 800), (1, 250), (2, 250), (3, 100), (5, 100), (6, expected), (-1, expected),
    ])


def test_loan_status_points(spark):
    check(spark, "loan_status_category string", scoring.loan_status_points(CFG), [
        ("FULLY_PAID", 800), ("CURRENT", 500), ("GRACE_PERIOD", 250), ("LATE", 100), ("CHARGED_OFF", 0),
        ("DEFAULT", 0), ("OTHER", 0), (None, 0),
    ])


def test_home_ownership_points(spark):
    check(spark, "home_ownership string", scoring.home_ownership_points(CFG), [
        ("OWN", 800), ("own", 800), ("Mortgage", 500), ("rent", 250), ("ANY", 100), (None, 100),
    ])


def test_credit_utilization_points(spark):
    check(spark, "funded_amount double, total_high_credit_limit double", scoring.credit_utilization_points(CFG), [
        ((10.0, 100.0), 800), ((10.01, 100.0), 650), ((30.0, 100.0), 650), ((30.01, 100.0), 500),
        ((50.0, 100.0), 500), ((50.01, 100.0), 250), ((70.0, 100.0), 250), ((70.01, 100.0), 0),
        ((10.0, 0.0), 0), ((None, 100.0), 0), ((10.0, None), 0),
    ])


def test_grade_points(spark):
    check(spark, "grade string", scoring.grade_points(CFG), [
        ("A", 800), ("B", 650), ("C", 500), ("D", 250), ("E", 100), ("F", 0), ("G", 0), (None, 0), ("a", 0),
    ])


def test_letter_grade(spark):
    check(spark, "credit_risk_score double", scoring.letter_grade(CFG), [
        (2500.5, "A"), (2500.0, "B"), (2000.5, "B"), (2000.0, "C"), (1500.5, "C"), (1500.0, "D"),
        (1000.5, "D"), (1000.0, "E"), (750.5, "E"), (750.0, "F"), (80.0, "F"), (None, "F"),
    ])


def test_weighted_scores(spark):
    df = spark.createDataFrame(
        [(800, 800, 800, 800, 800, 800, 800, 800, 800, 800), (0, 0, 0, 100, 0, 0, 0, 100, 0, 0)],
        ", ".join(f"{c} int" for cols in scoring.SUB_SCORES.values() for c in cols),
    )
    weights = (CFG.payment_weight, CFG.default_weight, CFG.financial_weight)
    scored = df.withColumns(
        {name: scoring.weighted_score(name, w) for name, w in zip(scoring.SUB_SCORES, weights)}
    ).withColumn("total", scoring.total_score())
    rows = [tuple(r) for r in scored.select(*scoring.SUB_SCORES, "total").orderBy(F.desc("total")).collect()]
    assert rows == [(320.0, 1440.0, 1120.0, 2880.0), (0.0, 45.0, 35.0, 80.0)]


def test_scoring_config_rejects_bad_settings():
    with pytest.raises(ValueError):
        ScoringConfig(payment_weight=0.5)
    with pytest.raises(ValueError):
        ScoringConfig(grade_bounds=(("A", 10.0), ("B", 20.0)))


def test_other_points_and_bounds_are_used(spark):
    cfg = ScoringConfig(excellent=9, grade_bounds=(("P", 5.0),), lowest_grade="Q")
    check(spark, "grade string", scoring.grade_points(cfg), [("A", 9), ("B", 650)])
    check(spark, "credit_risk_score double", scoring.letter_grade(cfg), [(6.0, "P"), (5.0, "Q")])

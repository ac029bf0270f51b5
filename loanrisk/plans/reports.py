"""Summaries over the finished tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def grade_distribution(scores: DataFrame) -> DataFrame:
    return (
        scores.groupBy("credit_risk_grade")
        .agg(F.count(F.lit(1)).alias("loan_count"))
        .orderBy("credit_risk_grade")
    )


def vintage_summary(loans: DataFrame, scores: DataFrame) -> DataFrame:
    """Per issue month: loans, amount lent, mean score and share charged off.

    Loans without a score count towards everything but the mean.
    """
    scored = scores.select("loan_id", "credit_risk_score")
    return (
        loans.select("loan_id", "vintage_month", "loan_amount", "loan_status_category")
        .join(scored, "loan_id", "left")
        .groupBy("vintage_month")
        .agg(
            F.count(F.lit(1)).alias("loan_count"),
            F.sum("loan_amount").alias("total_loan_amount"),
            F.avg("credit_risk_score").alias("avg_credit_risk_score"),
            F.avg((F.col("loan_status_category") == "CHARGED_OFF").cast("double")).alias(
                "charged_off_share"
            ),
        )
    )


def region_summary(scores: DataFrame) -> DataFrame:
    """Per region (null: unknown state): loans, members, amount lent, mean income and mean score.

    Members are counted from one row per (region, member), built with map-side partial sums.
    """
    per_member = scores.groupBy("address_region", "member_id").agg(
        F.count(F.lit(1)).alias("_loans"),
        F.sum("loan_amount").alias("_amount"),
        F.sum("annual_income").alias("_income"),
        F.sum("credit_risk_score").alias("_score"),
    )
    return per_member.groupBy("address_region").agg(
        F.sum("_loans").alias("loan_count"),
        F.count(F.lit(1)).alias("member_count"),
        F.sum("_amount").alias("total_loan_amount"),
        (F.sum("_income") / F.sum("_loans")).alias("avg_annual_income"),
        (F.sum("_score") / F.sum("_loans")).alias("avg_credit_risk_score"),
    )

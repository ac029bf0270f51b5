"""Silver and Gold by member part, so that an append rebuilds only the parts its loans touch.

All six tables but Bronze are stored in folders by a hash of the member. Loans of an append have ids
that Bronze did not hold, so they are new rows of the facts and change none. They can change their
members: the newest record of each member is kept with the columns that decide between records, and
the newest of that and the new loans is the newest of all. The mean employment length is kept as a
sum and a count per part. Everything else of a member (versions, default history, the scores of its
loans) is derived inside its part.

`load_state` says whether the tables hold what Bronze holds. A run that does not get to its end
leaves it open, and the next one builds all parts from Bronze again.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanrisk import config as c
from loanrisk.functions.text import first_number
from loanrisk.operators.skew import key_counts
from loanrisk.plans import gold, silver
from loanrisk.sources import files
from loanrisk.sources.tables import read_parts, read_table, replace_parts, table_exists, write_table

SILVER = (c.DIM_CUSTOMERS, c.FACT_LOANS, c.FACT_REPAYMENTS, c.DIM_DEFAULTERS)


def with_part(rows: DataFrame, parts: int) -> DataFrame:
    return rows.withColumn(c.MEMBER_PART, F.pmod(F.xxhash64("member_id"), F.lit(parts)).cast("int"))


def touched_parts(loans: DataFrame, parts: int) -> list[int]:
    """The parts of the members of some loans: at most `parts` numbers."""
    return sorted(row[0] for row in with_part(loans.select("member_id"), parts).select(c.MEMBER_PART).distinct().collect())


def check_layout(layout: c.TableLayout, parts: int) -> None:
    if layout.path is None or layout.fmt != "parquet":
        raise ValueError("tables by member part need a path layout of Parquet files")
    if parts < 1:
        raise ValueError(f"member_parts must be positive, got {parts}")


def open_state(spark: SparkSession, layout: c.TableLayout, parts: int | None) -> bool:
    """Note that a run begins; whether the stored tables were complete, in as many parts."""
    complete = False
    if table_exists(spark, layout, c.LOAD_STATE):
        state = read_table(spark, layout, c.LOAD_STATE).first()  # the table has one row
        complete = state["complete"] and state["parts"] == parts
    elif parts is None:
        return False
    _note(spark, layout, parts, complete=False)
    return complete


def close_state(spark: SparkSession, layout: c.TableLayout, parts: int) -> None:
    _note(spark, layout, parts, complete=True)


def _note(spark: SparkSession, layout: c.TableLayout, parts: int | None, complete: bool) -> None:
    state = spark.range(1).select(F.lit(parts).cast("int").alias("parts"), F.lit(complete).alias("complete"))
    write_table(state.coalesce(1), layout, c.LOAD_STATE)


def _put(rows: DataFrame, layout: c.TableLayout, table: str, parts: int, touched: Sequence[int] | None) -> None:
    """Store all parts, or replace the touched ones. A table without rows is one empty file."""
    made = with_part(rows, parts)
    if touched is not None:
        replace_parts(made, layout, table, touched)
        return
    write_table(made, layout, table, partition_by=[c.MEMBER_PART])
    if not files.matching(rows.sparkSession, layout.locate(table), f"{c.MEMBER_PART}=*"):
        write_table(made.limit(0), layout, table)


def _get(spark: SparkSession, layout: c.TableLayout, table: str, touched: Sequence[int] | None) -> DataFrame:
    return read_parts(spark, layout, table, touched).drop(c.MEMBER_PART)


def build_silver(
    spark: SparkSession,
    layout: c.TableLayout,
    rows: DataFrame,
    parts: int,
    touched: Sequence[int] | None = None,
    load_date: date | None = None,
    limits: c.QualityLimits = c.QualityLimits(),
) -> None:
    """The Silver tables from all of Bronze or, if `touched` is given, after an append of `rows`."""

    def newest(table: str, candidates: DataFrame, choose) -> DataFrame:
        if touched is not None:
            candidates = _get(spark, layout, table, touched).unionByName(candidates)
        _put(choose(candidates), layout, table, parts, touched)
        return silver.without_ties(_get(spark, layout, table, touched))

    def facts(table: str, made: DataFrame) -> None:
        if touched is None:
            _put(made, layout, table, parts, None)
        else:
            write_table(with_part(made, parts), layout, table, mode="append", partition_by=[c.MEMBER_PART])

    def loans() -> None:
        facts(c.FACT_LOANS, silver.fact_loans(rows))
        # Counted in the touched folders, of which the member column alone is read.
        _put(key_counts(_get(spark, layout, c.FACT_LOANS, touched), "member_id"), layout, c.MEMBER_LOANS, parts, touched)

    def customers() -> None:
        versions = None
        if table_exists(spark, layout, c.DIM_CUSTOMERS):
            whole = read_table(spark, layout, c.DIM_CUSTOMERS)
            versions = whole if touched is None else _get(spark, layout, c.DIM_CUSTOMERS, touched)
        latest = newest(c.LATEST_CUSTOMERS, silver.customer_candidates(rows), silver.newest_customers)
        _sum_years(spark, layout, touched)
        attributes = silver.complete_customers(latest, limits, _mean_years(spark, layout))
        if versions is None:
            made = silver.first_versions(attributes, load_date)
        else:
            made = silver.later_versions(versions, attributes, load_date)
        _put(made, layout, c.DIM_CUSTOMERS, parts, touched)

    def defaulters() -> None:
        latest = newest(c.LATEST_DEFAULTERS, silver.defaulter_candidates(rows), silver.newest_defaulters)
        _put(silver.complete_defaulters(latest), layout, c.DIM_DEFAULTERS, parts, touched)

    jobs = [
        customers,
        defaulters,
        loans,
        lambda: facts(c.FACT_REPAYMENTS, silver.fact_repayments(rows)),
    ]
    # The four chains do not depend on each other, so their jobs share the cluster.
    run = inheritable_thread_target(spark)(lambda job: job())
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(run, job) for job in jobs]
    for job in running:
        job.result()


def _sum_years(spark: SparkSession, layout: c.TableLayout, touched: Sequence[int] | None) -> None:
    """Sum and count of the readable employment years per part: a row for each, `parts` at most."""
    latest = read_parts(spark, layout, c.LATEST_CUSTOMERS, touched)
    years = first_number("emp_length").cast("long")
    sums = latest.groupBy(F.col(c.MEMBER_PART).alias("part")).agg(F.sum(years).alias("years"), F.count(years).alias("members"))
    if touched is not None:
        others = read_table(spark, layout, c.EMPLOYMENT_YEARS).where(~F.col("part").isin(list(touched)))
        sums = others.unionByName(sums)
    write_table(sums.coalesce(1), layout, c.EMPLOYMENT_YEARS)


def _mean_years(spark: SparkSession, layout: c.TableLayout):
    sums = read_table(spark, layout, c.EMPLOYMENT_YEARS)
    return sums.agg(silver.whole_years(F.try_divide(F.sum("years"), F.sum("members")))).scalar()


def silver_tables(spark: SparkSession, layout: c.TableLayout, touched: Sequence[int] | None) -> dict[str, DataFrame]:
    return {table: _get(spark, layout, table, touched) for table in SILVER}


def build_gold(
    spark: SparkSession,
    layout: c.TableLayout,
    parts: int,
    touched: Sequence[int] | None = None,
    scoring: c.ScoringConfig = c.ScoringConfig(),
    skew: c.SkewConfig = c.SkewConfig(),
) -> None:
    """Scores of all parts or the touched ones. The facts of a scored loan name the same member, so
    both are in that member's part."""
    tables = silver_tables(spark, layout, touched)
    counts = _get(spark, layout, c.MEMBER_LOANS, touched)
    scores = gold.credit_risk_scores(*[tables[name] for name in SILVER], scoring, skew, member_counts=counts)
    _put(scores, layout, c.RISK_SCORES, parts, touched)

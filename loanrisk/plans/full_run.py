"""The full run: Bronze, the four Silver tables and Gold, each written once and read back.

The raw text is parsed once. A load that keeps its corrupt lines is landed first, by kind of record;
any other is counted while Bronze, or the batch of an append, is written from it.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loanrisk import config as c
from loanrisk.operators.append import new_rows
from loanrisk.operators.profile import PROFILE, load_profile, require_gates
from loanrisk.operators.quality import critical_nulls, key_report, observe_rows, require_filled, row_counts
from loanrisk.operators.skew import key_counts
from loanrisk.plans import bronze, gold, incremental, silver
from loanrisk.sources.raw_files import CORRUPT, add_audit_columns
from loanrisk.sources.shared_folder import new_shared_folder, staged
from loanrisk.sources.tables import create_schemas, file_names, read_files, read_table, table_exists, write_table


@dataclass
class RunReport:
    """Seconds per stage and rows per table.

    Rows of tables are counted in the written tables (for an append, those that came in). `raw` and
    `garbage` are counts of the raw records: those read, and those that are no loans; a load that
    keeps corrupt lines also has `rejected`, those put aside because their line does not fit.
    """

    seconds: dict[str, float] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)


#: The columns that no Bronze row may lack.
CRITICAL_COLUMNS = ("loan_amnt", "grade", "member_id")


def _count(report: RunReport, tables: dict[str, DataFrame]) -> None:
    for row in row_counts(tables).collect():  # one row per table
        report.rows[row["table_name"]] = row["row_count"]


def check_bronze(held: DataFrame) -> None:
    """Fail if Bronze is empty or lacks a critical value."""
    require_filled(critical_nulls(held, CRITICAL_COLUMNS))


def check_silver(tables: dict[str, DataFrame]) -> None:
    """Fail if a Silver table is empty or has a null key."""
    require_filled(key_report({name: (df, c.TABLE_KEY[name]) for name, df in tables.items()}))


#: How long to wait for counts that Spark reports after a job; then they are counted by another one.
COUNTS_WITHIN = 60.0


def _observed(observation: Observation, seconds: float = COUNTS_WITHIN) -> dict | None:
    """What an observation has seen, or None if Spark does not tell in time: it tells nothing of a
    plan from which the observed node was optimised away, and `get` would wait for ever."""
    found: list[dict] = []
    waiting = threading.Thread(target=lambda: found.append(observation.get), daemon=True)
    waiting.start()
    waiting.join(seconds)
    return found[0] if found else None


def _counted(raw: DataFrame) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """The raw records, and their counts once a job has written them.

    The job must have no shuffle behind the records: a result task counts once, however often it is
    tried, while a lost map output would be counted again.
    """
    loans = F.count_if(bronze.is_loan())
    observation = Observation(f"raw-{uuid.uuid4().hex}")

    def counts() -> dict[str, int]:
        seen = _observed(observation)
        if seen is None:
            seen = raw.agg(F.count(F.lit(1)).alias("row_count"), loans.alias("loans")).first().asDict()
        return {"raw": seen["row_count"], "garbage": seen["row_count"] - seen["loans"]}

    return observe_rows(raw, observation, loans=loans), counts


def _landed(raw: DataFrame) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """The readable records, the rejected ones, and counts: parsed once, written by kind."""
    kind = F.when(F.col(CORRUPT).isNotNull(), "rejected").when(bronze.is_loan(), "loan").otherwise("garbage")
    path = new_shared_folder(raw.sparkSession, "raw-records")
    raw.withColumn("_kind", kind).write.partitionBy("_kind").parquet(path)
    schema = raw.schema.add("_kind", "string")
    rows = raw.sparkSession.read.schema(schema).parquet(path)
    per_kind = {row["_kind"]: row["count"] for row in rows.groupBy("_kind").count().collect()}  # three at most
    counts = {name: per_kind.get(name, 0) for name in ("garbage", "rejected")}
    rejected = rows.where("_kind = 'rejected'").select(CORRUPT)
    return rows.where("_kind <> 'rejected'").drop("_kind", CORRUPT), rejected, counts | {"raw": sum(per_kind.values())}


def _check_gates(
    spark: SparkSession, layout: c.TableLayout, load: DataFrame, limits: c.QualityLimits, gates: c.LoadGates
) -> None:
    """Profile the load, compare it with the last one that passed, and store the profile if it passes."""
    columns = list(dict.fromkeys([*gates.null_fractions, *limits.ranges]))
    lines = load_profile(load, columns, limits).collect()  # one per column
    last, number = None, 0
    if table_exists(spark, layout, c.LOAD_PROFILES):
        before = read_table(spark, layout, c.LOAD_PROFILES)
        newest = before.agg(F.max(F.struct("load_number", "row_count")).alias("last")).first()["last"]
        if newest is not None:
            number, last = newest
    require_gates(lines, last, gates)
    profile = spark.createDataFrame(lines, PROFILE).withColumn("load_number", F.lit(number + 1).cast("long"))
    write_table(profile, layout, c.LOAD_PROFILES, mode="append")


#: The JVM interprets methods of more bytes for ever; Spark then makes smaller ones, stage by stage.
COMPILED_BYTES = 8000
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def _compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Plans started inside get methods that the JVM compiles: records are so wide that the single method
    of a whole stage may be too long for it. A lower limit of the session stays."""
    before = spark.conf.get(_METHOD_LIMIT)
    spark.conf.set(_METHOD_LIMIT, str(min(int(before), COMPILED_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(_METHOD_LIMIT, before)


def full_run(
    spark: SparkSession,
    raw: DataFrame,
    layout: c.TableLayout,
    source_file: str = "landing",
    batch_ts: datetime | None = None,
    load_date: date | None = None,
    scoring: c.ScoringConfig = c.ScoringConfig(),
    limits: c.QualityLimits = c.QualityLimits(),
    skew: c.SkewConfig = c.SkewConfig(),
    fact_buckets: int | None = None,
    append: bool = False,
    validate: bool = True,
    loan_partitions: Sequence[str] = (),
    gates: c.LoadGates | None = None,
    member_parts: int | None = None,
) -> RunReport:
    """Build every table from raw records.

    By default the records replace Bronze. With `append`, Bronze keeps what it holds and gains the
    records whose id it does not have yet (see `operators.append`); Silver and Gold are rebuilt. In
    either case a customer dimension that is stored already keeps its versions and gains those of this
    load (see `silver.dim_customers_after`); Gold scores current versions only.

    Each stage reads the stored result of the one before, so a lost executor costs a recomputation
    from stored files, never from the raw text: also the records of an append are written to the
    shared folder before they are compared with a stored Bronze. Tables are swapped in whole (see `sources.tables`). With
    `validate`, Bronze is checked before Silver is built and Silver before Gold; a failed check raises
    `QualityError` and leaves the later tables as they were, and so does a load that fails its
    `gates`, which are compared with the last load that passed. Records whose line does not fit
    the schema (`read_raw_csv(keep_lines=True)`) go to `rejected_raw_lines` and nowhere else. With
    `fact_buckets` (catalog layouts) both facts and Gold are bucketed by loan, and their joins need no
    exchange; `loan_partitions`, such as `issue_year`, are the folders of `fact_loans`.

    With `member_parts` (Parquet under a path, neither buckets nor loan partitions), Silver and Gold
    are stored in that many folders by a hash of the member, and an append rebuilds only the folders
    that its new loans' members are in (see `plans.incremental`); it checks the rows it wrote. All are
    rebuilt if the last run did not end well or used another number. The tables equal those of a full
    rebuild. Only versions in touched folders are compared with the load's date.
    """
    with _compiled_methods(spark):
        return _run(spark, raw, layout, source_file, batch_ts, load_date, scoring, limits, skew, fact_buckets,
                    append, validate, loan_partitions, gates, member_parts)


def _run(
    spark: SparkSession,
    raw: DataFrame,
    layout: c.TableLayout,
    source_file: str,
    batch_ts: datetime | None,
    load_date: date | None,
    scoring: c.ScoringConfig,
    limits: c.QualityLimits,
    skew: c.SkewConfig,
    fact_buckets: int | None,
    append: bool,
    validate: bool,
    loan_partitions: Sequence[str],
    gates: c.LoadGates | None,
    member_parts: int | None,
) -> RunReport:
    report = RunReport()
    if member_parts is not None:
        incremental.check_layout(layout, member_parts)
        if fact_buckets or loan_partitions:
            raise ValueError("member_parts goes with neither fact_buckets nor loan_partitions")
    create_schemas(spark, layout)
    complete = incremental.open_state(spark, layout, member_parts)

    start = time.monotonic()
    if CORRUPT in raw.columns:
        records, rejected, found = _landed(raw)
        rejected = add_audit_columns(rejected, source_file, batch_ts)
        write_table(rejected, layout, c.REJECTED_LINES, mode="append" if append else "overwrite")
        counts = lambda: found
    else:
        records, counts = _counted(raw)
    arriving = bronze.to_bronze(records, source_file, batch_ts)
    before = 0
    later = append and table_exists(spark, layout, c.RAW_LOANS)
    if later:
        arriving = load = staged(arriving, "loan-batch")
        held = read_table(spark, layout, c.RAW_LOANS)
        before = held.count()
        arriving = new_rows(held, arriving, config=skew)
        known_files = set(file_names(spark, layout, c.RAW_LOANS)) if member_parts else ()
    write_table(arriving, layout, c.RAW_LOANS, mode="append" if later else "overwrite")
    report.rows |= counts()
    stored = read_table(spark, layout, c.RAW_LOANS)
    _count(report, {c.RAW_LOANS: stored})
    report.rows[c.RAW_LOANS] -= before
    if append and not later:
        arriving = stored  # there was nothing to compare it with
    elif later and member_parts:  # the new loans are not written a second time, but read where they are
        added = [name for name in file_names(spark, layout, c.RAW_LOANS) if name not in known_files]
        arriving = read_files(spark, layout, c.RAW_LOANS, added)
    touched = incremental.touched_parts(arriving, member_parts) if append and complete else None
    if validate and touched != []:
        check_bronze(stored if touched is None else arriving)
    if gates:
        _check_gates(spark, layout, load if later else stored, limits, gates)
    report.seconds["bronze"] = time.monotonic() - start

    if member_parts is not None:
        _by_parts(report, spark, layout, stored if touched is None else arriving, member_parts, touched,
                  load_date, limits, validate, scoring, skew)
        return report

    start = time.monotonic()
    buckets = {"bucket_by": (fact_buckets, "loan_id")} if fact_buckets else {}
    by_year = {"partition_by": loan_partitions} if loan_partitions else {}

    def customers() -> DataFrame:
        if not table_exists(spark, layout, c.DIM_CUSTOMERS):
            return silver.dim_customers(stored, load_date, limits)
        return silver.dim_customers_after(read_table(spark, layout, c.DIM_CUSTOMERS), stored, load_date, limits)

    silver_tables = [
        (c.DIM_CUSTOMERS, customers, {}),
        (c.FACT_LOANS, lambda: silver.fact_loans(stored), buckets | by_year),
        (c.FACT_REPAYMENTS, lambda: silver.fact_repayments(stored), buckets),
        (c.DIM_DEFAULTERS, lambda: silver.dim_defaulters(stored), {}),
    ]

    def write(table: str, made: Callable[[], DataFrame], how: dict) -> None:
        write_table(made(), layout, table, **how)
        if table == c.FACT_LOANS:
            write_table(key_counts(read_table(spark, layout, table), "member_id"), layout, c.MEMBER_LOANS)

    # The four tables do not depend on each other, so their jobs share the cluster.
    write_one = inheritable_thread_target(spark)(write)
    with ThreadPoolExecutor(len(silver_tables)) as pool:
        written = [pool.submit(write_one, table, made, how) for table, made, how in silver_tables]
    for job in written:
        job.result()
    tables = {table: read_table(spark, layout, table) for table, _, _ in silver_tables}
    _count(report, tables)
    if validate:
        check_silver(tables)
    report.seconds["silver"] = time.monotonic() - start

    start = time.monotonic()
    counts_of_members = read_table(spark, layout, c.MEMBER_LOANS)
    scores = gold.credit_risk_scores(*tables.values(), scoring, skew, member_counts=counts_of_members)
    write_table(scores, layout, c.RISK_SCORES, **buckets)
    _count(report, {c.RISK_SCORES: read_table(spark, layout, c.RISK_SCORES)})
    report.seconds["gold"] = time.monotonic() - start
    return report


def _by_parts(
    report: RunReport,
    spark: SparkSession,
    layout: c.TableLayout,
    rows: DataFrame,
    parts: int,
    touched: list[int] | None,
    load_date: date | None,
    limits: c.QualityLimits,
    validate: bool,
    scoring: c.ScoringConfig,
    skew: c.SkewConfig,
) -> None:
    """Silver and Gold of a run with `member_parts`. An append without new loans changes nothing."""
    start = time.monotonic()
    if touched != []:
        incremental.build_silver(spark, layout, rows, parts, touched, load_date, limits)
        if validate:
            check_silver(incremental.silver_tables(spark, layout, touched))
    report.seconds["silver"] = time.monotonic() - start

    start = time.monotonic()
    if touched != []:
        incremental.build_gold(spark, layout, parts, touched, scoring, skew)
    _count(report, {t: read_table(spark, layout, t) for t in c.TABLE_LAYER if t != c.RAW_LOANS})
    incremental.close_state(spark, layout, parts)
    report.seconds["gold"] = time.monotonic() - start


def stored_tables(spark: SparkSession, layout: c.TableLayout) -> dict[str, DataFrame]:
    return {table: read_table(spark, layout, table) for table in c.TABLE_LAYER}

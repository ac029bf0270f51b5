"""Later loads: versions, safe overwrites, counts from one parse, rejected lines and gates."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from loanrisk import config as c
from loanrisk.checks.loan_view import raw_loans
from loanrisk.operators import profile, quality
from loanrisk.plans import bronze, full_run, silver
from loanrisk.sources import tables as stored_tables
from loanrisk.sources.raw_files import read_raw_csv
from loanrisk.sources.raw_schema import RAW_COLUMNS
from loanrisk.sources.tables import read_table, table_exists, write_table

SMALL = "/root/testdata/sf0.001"


def layout_at(path):
    return c.TableLayout(path=str(path))


# ---- versions ----------------------------------------------------------------------------------


def test_a_second_load_of_the_same_records_changes_no_version(spark, tmp_path):
    layout, raw = layout_at(tmp_path), raw_loans(spark, SMALL)
    for day in (date(2024, 1, 1), date(2024, 2, 1)):
        full_run.full_run(spark, raw, layout, load_date=day)
    dim = read_table(spark, layout, c.DIM_CUSTOMERS)
    assert {(r[0], r[1]) for r in dim.select("effective_date", "is_current").distinct().collect()} == {(date(2024, 1, 1), True)}
    assert dim.select("member_id").distinct().count() == dim.count()


def test_current_versions_are_those_of_one_load_of_everything(spark, tmp_path):
    layout, raw = layout_at(tmp_path), raw_loans(spark, SMALL)
    half = raw.where("CAST(url AS BIGINT) % 2 = 1")
    full_run.full_run(spark, half, layout, load_date=date(2024, 1, 1))
    full_run.full_run(spark, raw, layout, load_date=date(2024, 2, 1), append=True)
    dim = read_table(spark, layout, c.DIM_CUSTOMERS)
    whole = silver.dim_customers(read_table(spark, layout, c.RAW_LOANS))
    columns = ["member_id", *silver.TRACKED_ATTRIBUTES, "income_bracket", "emp_category", "address_region"]
    ours, theirs = dim.where("is_current").select(columns), whole.select(columns)
    assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()
    closed = dim.where("not is_current")
    assert closed.count() > 0
    assert closed.where("end_date <> date'2024-02-01' or effective_date <> date'2024-01-01'").isEmpty()
    # a closed version keeps its first time stamp, and Gold has one row per loan still
    gold = read_table(spark, layout, c.RISK_SCORES)
    assert gold.count() == gold.select("loan_id").distinct().count() > 0


def test_a_load_from_before_the_current_versions_is_refused_and_changes_nothing(spark, tmp_path):
    layout, raw = layout_at(tmp_path), raw_loans(spark, SMALL)
    full_run.full_run(spark, raw, layout, load_date=date(2024, 2, 1))
    before = read_table(spark, layout, c.DIM_CUSTOMERS).count()
    with pytest.raises(Exception, match="older than a current version"):
        full_run.full_run(spark, raw, layout, load_date=date(2024, 1, 1))
    assert read_table(spark, layout, c.DIM_CUSTOMERS).count() == before


# ---- overwrite ---------------------------------------------------------------------------------


def failing(spark):
    row = F.when(F.col("id") == 77, F.raise_error(F.lit("broken row")).cast("long")).otherwise(F.col("id"))
    return spark.range(0, 100, 1, 4).select(row.alias("id"))


@pytest.mark.parametrize("by_path", [True, False])
def test_an_overwrite_that_fails_halfway_leaves_the_old_table(spark, tmp_path, by_path):
    layout = layout_at(tmp_path / "lake") if by_path else c.TableLayout(bronze="o_bronze", silver="o_silver", gold="o_gold")
    stored_tables.create_schemas(spark, layout)
    write_table(spark.range(10), layout, c.DIM_CUSTOMERS)
    with pytest.raises(Exception, match="broken row"):
        write_table(failing(spark), layout, c.DIM_CUSTOMERS)
    assert read_table(spark, layout, c.DIM_CUSTOMERS).count() == 10
    if by_path:
        assert [p.name for p in (tmp_path / "lake/silver").iterdir()] == [c.DIM_CUSTOMERS]
    else:
        assert [t.name for t in spark.catalog.listTables("o_silver")] == [c.DIM_CUSTOMERS]


@pytest.mark.parametrize("by_path", [True, False])
def test_a_swap_that_dies_between_its_renames_is_undone(spark, tmp_path, monkeypatch, by_path):
    layout = layout_at(tmp_path / "lake") if by_path else c.TableLayout(bronze="p_bronze", silver="p_silver", gold="p_gold")
    stored_tables.create_schemas(spark, layout)
    write_table(spark.range(10), layout, c.DIM_CUSTOMERS)
    move, place = stored_tables._move, layout.locate(c.DIM_CUSTOMERS)

    def dying(session, source, to, kind):
        if to == place:
            raise RuntimeError("the driver is gone")
        move(session, source, to, kind)

    with monkeypatch.context() as patched:
        patched.setattr(stored_tables, "_move", dying)
        with pytest.raises(RuntimeError):
            write_table(spark.range(7), layout, c.DIM_CUSTOMERS)
    assert table_exists(spark, layout, c.DIM_CUSTOMERS)
    assert read_table(spark, layout, c.DIM_CUSTOMERS).count() == 10
    write_table(spark.range(7), layout, c.DIM_CUSTOMERS)
    assert read_table(spark, layout, c.DIM_CUSTOMERS).count() == 7


def test_a_table_can_be_replaced_by_what_is_read_from_it(spark, tmp_path):
    layout = layout_at(tmp_path)
    write_table(spark.range(10), layout, c.DIM_CUSTOMERS)
    write_table(read_table(spark, layout, c.DIM_CUSTOMERS).where("id > 3"), layout, c.DIM_CUSTOMERS)
    assert read_table(spark, layout, c.DIM_CUSTOMERS).count() == 6


# ---- one parse ---------------------------------------------------------------------------------


def test_the_raw_text_is_scanned_once(spark, tmp_path, monkeypatch):
    raw_loans(spark, SMALL).write.csv(str(tmp_path / "csv"), header=True)
    written = []
    write = full_run.write_table

    def spy(df, layout, table, *args, **how):
        written.append((table, df._jdf.queryExecution().executedPlan().toString()))
        write(df, layout, table, *args, **how)

    monkeypatch.setattr(full_run, "write_table", spy)
    report = full_run.full_run(spark, read_raw_csv(spark, str(tmp_path / "csv")), layout_at(tmp_path / "lake"))
    scans = {table: len(re.findall("FileScan csv", plan)) for table, plan in written}
    assert scans.pop(c.RAW_LOANS) == 1 and not any(scans.values())
    raw = raw_loans(spark, SMALL)
    assert report.rows["raw"] == raw.count()
    assert report.rows["garbage"] == raw.count() - bronze.filter_garbage(raw).count()


def test_counts_come_from_another_job_if_spark_does_not_tell_them(spark, monkeypatch):
    monkeypatch.setattr(full_run, "COUNTS_WITHIN", 0.5)
    monkeypatch.setattr(full_run._observed, "__defaults__", (0.5,))
    raw = raw_loans(spark, SMALL)
    _, counts = full_run._counted(raw)  # no job runs on the observed records
    assert counts()["raw"] == raw.count()


def test_customers_derive_the_member_key_once(spark):
    held = bronze.to_bronze(raw_loans(spark, SMALL))
    plan = silver.latest_customers(held)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("sha2(") == 1
    final = silver.dim_customers(held)._jdf.queryExecution().executedPlan().toString()
    assert "sha2(" not in final and "orders" not in final


# ---- rejected lines ----------------------------------------------------------------------------


def test_lines_that_do_not_fit_are_put_aside(spark, tmp_path):
    good = raw_loans(spark, SMALL).limit(200)
    good.coalesce(1).write.csv(str(tmp_path / "csv"), header=True)
    width = len(RAW_COLUMNS)
    junk = ["only,three,fields", ",".join(["x"] * (width + 2)), "plain words"]
    bad_number = ["x"] * width
    (tmp_path / "csv" / "part-junk.csv").write_text("\n".join([",".join(RAW_COLUMNS), *junk, ",".join(bad_number)]) + "\n")
    raw = read_raw_csv(spark, str(tmp_path / "csv"), keep_lines=True)
    layout = layout_at(tmp_path / "lake")
    report = full_run.full_run(spark, raw, layout, validate=False)
    rejected = read_table(spark, layout, c.REJECTED_LINES)
    assert sorted(r[0] for r in rejected.select("_corrupt_record").collect()) == sorted([*junk, ",".join(bad_number)])
    assert report.rows["rejected"] == 4
    assert report.rows["raw"] == 204 == report.rows["rejected"] + report.rows["garbage"] + report.rows[c.RAW_LOANS]
    assert read_table(spark, layout, c.RAW_LOANS).columns[: len(RAW_COLUMNS)] == list(RAW_COLUMNS)
    full_run.full_run(spark, raw, layout, validate=False, append=True)
    assert read_table(spark, layout, c.REJECTED_LINES).count() == 8


# ---- gates -------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "gates, message",
    [
        (c.LoadGates(null_fractions={"emp_title": 0.001}), "emp_title"),
        (c.LoadGates(range_fraction=0.0), "annual_inc"),
        (c.LoadGates(row_change=0.1), "in the load before"),
    ],
)
def test_a_load_that_fails_a_gate_leaves_gold_as_it_was(spark, tmp_path, gates, message):
    layout, raw = layout_at(tmp_path), raw_loans(spark, SMALL)
    calm = raw.where("annual_inc < 10000000").withColumn("emp_title", F.coalesce("emp_title", F.lit("Clerk")))
    full_run.full_run(spark, calm, layout, load_date=date(2024, 1, 1), gates=gates)
    before = read_table(spark, layout, c.RISK_SCORES).agg(F.count(F.lit(1)), F.max("_scored_at")).first()
    profiles = read_table(spark, layout, c.LOAD_PROFILES).count()
    worse = raw.where("CAST(url AS BIGINT) % 2 = 0")
    with pytest.raises(quality.QualityError, match=message):
        full_run.full_run(spark, worse, layout, load_date=date(2024, 2, 1), gates=gates)
    assert read_table(spark, layout, c.RISK_SCORES).agg(F.count(F.lit(1)), F.max("_scored_at")).first() == before
    assert read_table(spark, layout, c.LOAD_PROFILES).count() == profiles


def test_a_profile_is_one_pass(spark):
    lines = {r["column_name"]: r for r in profile.load_profile(raw_loans(spark, SMALL), ["annual_inc", "title"]).collect()}
    raw = raw_loans(spark, SMALL)
    assert lines["title"]["null_count"] == raw.where("title is null").count()
    assert lines["annual_inc"]["outside_count"] == raw.where("annual_inc > 10000000").count() > 0
    assert lines["title"]["outside_count"] is None
    plan = profile.load_profile(raw, ["annual_inc", "title"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1


# ---- work of a load ----------------------------------------------------------------------------


def test_records_are_derived_in_as_many_tasks_as_there_are_cores(spark):
    raw = raw_loans(spark, SMALL)  # its orders are one row group
    held = raw.select("url").withColumn("task", F.spark_partition_id()).groupBy("task").count()
    assert held.count() >= spark.sparkContext.defaultParallelism


def test_a_first_append_is_written_once(spark, tmp_path, monkeypatch):
    purposes, real = [], full_run.staged
    monkeypatch.setattr(full_run, "staged", lambda df, purpose: purposes.append(purpose) or real(df, purpose))
    layout, raw = layout_at(tmp_path), raw_loans(spark, SMALL)
    first = raw.where("CAST(url AS BIGINT) % 2 = 1")
    report = full_run.full_run(spark, first, layout, append=True, gates=c.LoadGates())
    assert purposes == [] and report.rows[c.RAW_LOANS] == bronze.to_bronze(first).count()
    full_run.full_run(spark, raw, layout, append=True)
    assert purposes == ["loan-batch"]
    ids = read_table(spark, layout, c.RAW_LOANS).where("id is not null").select("id")
    assert ids.exceptAll(bronze.to_bronze(raw).select("id")).isEmpty()


def test_a_run_has_methods_that_the_jvm_compiles_and_leaves_the_session_alone(spark, monkeypatch):
    name, seen = "spark.sql.codegen.hugeMethodLimit", []
    before = spark.conf.get(name)

    def run(*_):
        seen.append(int(spark.conf.get(name)))
        raise ValueError("stop")

    monkeypatch.setattr(full_run, "_run", run)
    with pytest.raises(ValueError, match="stop"):
        full_run.full_run(spark, None, layout_at("/nowhere"))
    assert seen == [8000] and spark.conf.get(name) == before


def test_the_id_is_not_shuffled_twice(spark):
    held = bronze.to_bronze(raw_loans(spark, SMALL))
    for rows in (silver.latest_loans(held), silver.latest_repayments(held)):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert "_tie_url" in plan and "_tie_id" not in plan

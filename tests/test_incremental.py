"""Appends by member part: equal to a full rebuild, other parts unread and untouched, safe to break."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from loanrisk import config as c
from loanrisk.checks.loan_view import raw_loans
from loanrisk.plans import bronze, full_run, incremental
from loanrisk.sources import files
from loanrisk.sources import tables as stored_tables
from loanrisk.sources.shared_folder import staged
from loanrisk.sources.tables import read_parts, read_table, replace_parts

SMALL = "/root/testdata/sf0.001"
PARTS = 16
DAYS = (date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1))
STORED = [*incremental.SILVER, c.RISK_SCORES, c.MEMBER_LOANS, c.LATEST_CUSTOMERS, c.LATEST_DEFAULTERS]


def layout_at(path):
    return c.TableLayout(path=str(path))


def early(raw):
    return raw.where("id is not null and CAST(url AS BIGINT) % 300 <> 1")


def late(raw):
    """A handful of new loans, one of them of a new member."""
    moved = F.when(F.col("addr_state") == "IL", F.lit("MOVED")).otherwise(F.col("home_ownership"))
    return raw.where("CAST(url AS BIGINT) % 300 = 1").withColumn("home_ownership", moved)


def append(spark, load, layout, day, parts=PARTS, **how):
    return full_run.full_run(spark, load, layout, load_date=day, append=True, member_parts=parts, **how)


def same_tables(spark, ours, theirs):
    for table in (*c.TABLE_LAYER, c.MEMBER_LOANS):
        a, b = read_table(spark, ours, table), read_table(spark, theirs, table)
        assert a.columns == b.columns
        kept = [name for name in a.columns if not name.startswith("_")]
        a, b = a.select(kept), b.select(kept)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), table


def folders(path):
    """Files per member part of each table."""
    return {
        (p.parent.name, p.name): sorted(f.name for f in p.iterdir()) for p in path.glob(f"*/*/{c.MEMBER_PART}=*")
    }


def test_appends_equal_full_rebuilds_and_leave_other_parts_alone(spark, tmp_path, monkeypatch):
    raw, ours, theirs = raw_loans(spark, SMALL), layout_at(tmp_path / "parts"), layout_at(tmp_path / "whole")
    append(spark, early(raw), ours, DAYS[0])
    before = folders(tmp_path / "parts")
    plans = []
    replace = stored_tables.replace_parts

    def spy(df, layout, table, parts):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        replace(df, layout, table, parts)

    with monkeypatch.context() as patched:
        patched.setattr(incremental, "replace_parts", spy)
        report = append(spark, late(raw), ours, DAYS[1])
    touched = incremental.touched_parts(bronze.to_bronze(late(raw)), PARTS)
    assert 0 < len(touched) < PARTS
    after = folders(tmp_path / "parts")
    changed = {key for key in after if after[key] != before.get(key)}
    assert {name for _, name in changed} == {f"{c.MEMBER_PART}={part}" for part in touched}
    assert {table for table, _ in changed} == set(STORED)

    assert len(plans) == 6
    for plan in plans:
        scans = [line for line in re.split("FileScan parquet", plan)[1:] if f"{c.MEMBER_PART}#" in line]
        assert scans
        for scan in scans:
            assert re.search(rf"PartitionFilters: \[[^\]]*{c.MEMBER_PART}#\d+ (IN|INSET|=)", scan), scan

    for load, day in ((early(raw), DAYS[0]), (late(raw), DAYS[1])):
        whole = full_run.full_run(spark, load, theirs, load_date=day, append=True)
    same_tables(spark, ours, theirs)
    assert report.rows == whole.rows
    assert not read_table(spark, ours, c.DIM_CUSTOMERS).where("effective_date = date'2024-02-01'").isEmpty()


def test_new_loans_are_written_once(spark, tmp_path, monkeypatch):
    """Only the batch goes to the shared folder; Silver reads the new loans where Bronze keeps them."""
    raw, layout, copies = raw_loans(spark, SMALL), layout_at(tmp_path), []
    append(spark, early(raw), layout, DAYS[0])
    known = set(stored_tables.file_names(spark, layout, c.RAW_LOANS))

    def noted(df, purpose):
        copies.append(purpose)
        return staged(df, purpose)

    seen = []
    build = incremental.build_silver
    monkeypatch.setattr(full_run, "staged", noted)
    monkeypatch.setattr(incremental, "build_silver", lambda *a: (seen.append(a[2]), build(*a)))
    append(spark, late(raw), layout, DAYS[1])
    assert copies == ["loan-batch"]
    added = {name for name in stored_tables.file_names(spark, layout, c.RAW_LOANS) if name not in known}
    assert {name.rpartition("/")[2] for name in seen[0].inputFiles()} == added
    assert seen[0].count() == read_table(spark, layout, c.RAW_LOANS).count() - early(raw).where(bronze.is_loan()).count()


def test_an_append_of_known_loans_changes_nothing(spark, tmp_path):
    raw, layout = early(raw_loans(spark, SMALL)), layout_at(tmp_path)
    append(spark, raw, layout, DAYS[0])
    before = folders(tmp_path)
    report = append(spark, raw.limit(20), layout, DAYS[1])
    assert folders(tmp_path) == before and report.rows[c.RAW_LOANS] == 0
    empty = append(spark, raw.limit(0), layout, DAYS[1])
    assert folders(tmp_path) == before and empty.rows["raw"] == 0


@pytest.mark.parametrize("table", [c.DIM_CUSTOMERS, c.RISK_SCORES])
def test_a_broken_run_is_made_good_by_the_next_one(spark, tmp_path, monkeypatch, table):
    raw, ours, theirs = raw_loans(spark, SMALL), layout_at(tmp_path / "parts"), layout_at(tmp_path / "whole")
    append(spark, early(raw), ours, DAYS[0])
    replace = stored_tables.replace_parts

    def breaking(df, layout, name, parts):
        if name == table:
            raise RuntimeError("the driver is gone")
        replace(df, layout, name, parts)

    with monkeypatch.context() as patched:
        patched.setattr(incremental, "replace_parts", breaking)
        with pytest.raises(RuntimeError):
            append(spark, late(raw), ours, DAYS[1])
    append(spark, late(raw), ours, DAYS[1])  # its loans are known to Bronze by now
    for load, day in ((early(raw), DAYS[0]), (late(raw), DAYS[1])):
        full_run.full_run(spark, load, theirs, load_date=day, append=True)
    same_tables(spark, ours, theirs)


def test_other_numbers_of_parts_and_runs_without_parts_rebuild_all(spark, tmp_path):
    raw, ours, theirs = raw_loans(spark, SMALL), layout_at(tmp_path / "parts"), layout_at(tmp_path / "whole")
    half = early(raw).where("CAST(url AS BIGINT) % 2 = 0")
    loads = [(half, DAYS[0], 4), (early(raw), DAYS[1], None), (late(raw), DAYS[2], 3)]
    for load, day, parts in loads:
        append(spark, load, ours, day, parts)
        append(spark, load, theirs, day, None)
    same_tables(spark, ours, theirs)
    assert {name for _, name in folders(tmp_path / "parts")} == {f"{c.MEMBER_PART}={p}" for p in range(3)}


# ---- replacing parts ---------------------------------------------------------------------------


def numbered(spark, n, parts=4):
    return spark.range(n).withColumn(c.MEMBER_PART, (F.col("id") % parts).cast("int"))


def held(spark, layout):
    return {tuple(r) for r in read_parts(spark, layout, c.RISK_SCORES, None).select("id", c.MEMBER_PART).collect()}


def test_parts_are_replaced_added_and_emptied(spark, tmp_path):
    layout = layout_at(tmp_path)
    stored_tables.write_table(numbered(spark, 8), layout, c.RISK_SCORES, partition_by=[c.MEMBER_PART])
    own = read_parts(spark, layout, c.RISK_SCORES, [1]).where("id = 5")
    more = spark.sql(f"SELECT 90L AS id, 7 AS {c.MEMBER_PART}")
    replace_parts(own.unionByName(more), layout, c.RISK_SCORES, [1, 2, 7])
    assert held(spark, layout) == {(0, 0), (4, 0), (5, 1), (3, 3), (7, 3), (90, 7)}
    assert read_table(spark, layout, c.RISK_SCORES).columns == ["id"]
    assert [p.name for p in (tmp_path / "gold").iterdir()] == [c.RISK_SCORES]


def test_a_replacement_that_fails_changes_nothing(spark, tmp_path):
    layout = layout_at(tmp_path)
    stored_tables.write_table(numbered(spark, 8), layout, c.RISK_SCORES, partition_by=[c.MEMBER_PART])
    before = held(spark, layout)
    broken = numbered(spark, 80).withColumn(
        "id", F.when(F.col("id") == 77, F.raise_error(F.lit("broken row")).cast("long")).otherwise(F.col("id"))
    )
    with pytest.raises(Exception, match="broken row"):
        replace_parts(broken, layout, c.RISK_SCORES, [0, 1, 2, 3])
    assert held(spark, layout) == before


def test_a_folder_moved_away_comes_back(spark, tmp_path, monkeypatch):
    layout = layout_at(tmp_path)
    stored_tables.write_table(numbered(spark, 8), layout, c.RISK_SCORES, partition_by=[c.MEMBER_PART])
    move = files.move

    def dying(session, path, to):
        if to.endswith(f"{c.MEMBER_PART}=2"):
            raise RuntimeError("the driver is gone")
        move(session, path, to)

    with monkeypatch.context() as patched:
        patched.setattr(files, "move", dying)
        with pytest.raises(RuntimeError):
            replace_parts(numbered(spark, 80), layout, c.RISK_SCORES, [1, 2, 3])
    rows = held(spark, layout)
    assert {r for r in rows if r[1] == 2} == {(2, 2), (6, 2)}  # old
    assert {r for r in rows if r[1] == 3} == {(3, 3), (7, 3)}  # not reached
    assert len({r for r in rows if r[1] == 1}) == 20  # new


def test_odd_settings_are_refused(spark, tmp_path):
    raw = raw_loans(spark, SMALL)
    for layout, how in (
        (c.TableLayout(), {"member_parts": 4}),
        (layout_at(tmp_path), {"member_parts": 0}),
        (layout_at(tmp_path), {"member_parts": 4, "loan_partitions": ["issue_year"]}),
        (layout_at(tmp_path), {"member_parts": 4, "fact_buckets": 2}),
    ):
        with pytest.raises(ValueError):
            full_run.full_run(spark, raw, layout, **how)


def test_a_table_without_rows_keeps_its_columns(spark, tmp_path):
    layout = layout_at(tmp_path)
    nothing = raw_loans(spark, SMALL).where("false")
    report = append(spark, nothing, layout, DAYS[0], validate=False)
    assert set(report.rows.values()) == {0}
    append(spark, early(raw_loans(spark, SMALL)), layout, DAYS[1])
    assert read_table(spark, layout, c.RISK_SCORES).count() > 0

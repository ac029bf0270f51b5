from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.errors import PySparkException

from loanrisk.operators.history import OPEN_END, scd2_initial, scd2_merge

D1, D2, D3 = date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)
SCHEMA = "k string, grade string, income double, note string"
TRACKED = ["grade", "income"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def dim(spark):
    first = spark.createDataFrame(
        [("same", "A", 1.0, "n"), ("changed", "A", 1.0, "n"), ("filled", None, 1.0, "n"),
         ("missing", "C", 3.0, "n"), ("noted", "D", 4.0, "n")],
        SCHEMA,
    )
    return scd2_initial(first, D1)


@pytest.fixture(scope="module")
def incoming(spark):
    return spark.createDataFrame(
        [("same", "A", 1.0, "n"), ("changed", "B", 1.0, "n"), ("filled", "A", 1.0, "n"),
         ("noted", "D", 4.0, "other"), ("new", "E", None, "n")],
        SCHEMA,
    )


def test_initial(dim):
    assert {(r.effective_date, r.end_date, r.is_current) for r in dim.collect()} == {(D1, OPEN_END, True)}


def test_merge(dim, incoming):
    merged = scd2_merge(dim, incoming, "k", TRACKED, D2)
    assert merged.columns == dim.columns
    assert merged.dtypes == dim.dtypes
    assert rows(merged) == sorted(
        [
            ("same", "A", 1.0, "n", D1, OPEN_END, True),
            ("changed", "A", 1.0, "n", D1, D2, False),
            ("changed", "B", 1.0, "n", D2, OPEN_END, True),
            ("filled", None, 1.0, "n", D1, D2, False),
            ("filled", "A", 1.0, "n", D2, OPEN_END, True),
            ("missing", "C", 3.0, "n", D1, OPEN_END, True),
            ("noted", "D", 4.0, "n", D1, OPEN_END, True),
            ("new", "E", None, "n", D2, OPEN_END, True),
        ],
        key=str,
    )


def test_merging_twice_changes_nothing(dim, incoming):
    once = scd2_merge(dim, incoming, "k", TRACKED, D2)
    for day in (D2, D3):
        assert rows(scd2_merge(once, incoming, "k", TRACKED, day)) == rows(once)


def test_one_current_version_per_key_and_no_gaps(spark, dim, incoming):
    third = spark.createDataFrame([("changed", "A", 1.0, "n"), ("new", "E", 5.0, "n")], SCHEMA)
    merged = scd2_merge(scd2_merge(dim, incoming, "k", TRACKED, D2), third, "k", TRACKED, D3)
    versions = {}
    for r in merged.collect():
        versions.setdefault(r.k, []).append((r.effective_date, r.end_date, r.is_current))
    for spans in versions.values():
        spans.sort()
        assert [s[2] for s in spans] == [False] * (len(spans) - 1) + [True]
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert len(versions["changed"]) == 3 and len(versions["new"]) == 2


@pytest.mark.parametrize(
    "data, day, message",
    [
        ([("x", "A", 1.0, "n")], date(2023, 1, 1), "older than a current version"),
        ([("x", "A", 1.0, "n"), ("x", "B", 1.0, "n")], D2, "comes twice"),
        ([(None, "A", 1.0, "n")], D2, "is missing"),
    ],
)
def test_bad_loads_fail(spark, dim, data, day, message):
    with pytest.raises(PySparkException, match=message):
        scd2_merge(dim, spark.createDataFrame(data, SCHEMA), "k", TRACKED, day).collect()


def test_history_and_current_versions_move_once(spark, dim, incoming):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = scd2_merge(dim, incoming, "k", TRACKED, D2)._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.toString().count("Exchange") == 2


def test_a_change_on_the_opening_day_replaces_the_version(spark, dim, incoming):
    once = scd2_merge(dim, incoming, "k", TRACKED, D2)
    third = spark.createDataFrame([("changed", "Z", 9.0, "n")], SCHEMA)
    again = [r for r in scd2_merge(once, third, "k", TRACKED, D2).collect() if r.k == "changed"]
    assert all(r.effective_date < r.end_date for r in again)
    assert len(again) == once.where("k = 'changed'").count()
    assert [r.effective_date for r in again if r.is_current] == [D2]


def test_a_row_of_unknown_state_is_refused(spark, dim, incoming):
    broken = dim.withColumn("is_current", F.lit(None).cast("boolean"))
    with pytest.raises(PySparkException, match="is_current is null"):
        scd2_merge(broken, incoming, "k", TRACKED, D2).collect()


def test_current_versions_without_a_key_bypass_the_join(spark, dim, incoming):
    bare = scd2_initial(spark.createDataFrame([(None, "A", float(n), "n") for n in range(300)], SCHEMA), D1)
    merged = scd2_merge(dim.unionByName(bare), incoming, "k", TRACKED, D2)
    assert rows(merged) == sorted(rows(scd2_merge(dim, incoming, "k", TRACKED, D2)) + rows(bare), key=str)
    with pytest.raises(PySparkException, match="older than a current version"):
        scd2_merge(bare, incoming, "k", TRACKED, date(2023, 1, 1)).collect()
    with_tasks = merged.withColumn("task", F.spark_partition_id()).where("k is null")
    assert with_tasks.select("task").distinct().count() > 1


def test_a_missing_incoming_key_fails_before_the_window(spark, dim, incoming):
    plan = scd2_merge(dim, incoming, "k", TRACKED, D2)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window [") < plan.index("an incoming key is missing")

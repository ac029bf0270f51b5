import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from loanrisk.config import QualityLimits
from loanrisk.operators import quality


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(
        [("a", 1.0), ("a", 2.0), ("b", None), (None, -1.0), (None, 5.0)], "k string, v double"
    )


def test_observation_counts_while_writing(table):
    seen = Observation("seen")
    quality.observe_rows(table, seen, nulls=F.count_if(F.col("v").isNull())).collect()
    assert seen.get == {"row_count": 5, "nulls": 1}


def test_row_counts(table):
    report = quality.row_counts({"all": table, "none": table.where("false")})
    assert {tuple(r) for r in report.collect()} == {("all", 5), ("none", 0)}


def test_critical_nulls(table):
    assert quality.critical_nulls(table, ["k", "v"]).first().asDict() == {
        "row_count": 5, "k_nulls": 2, "v_nulls": 1,
    }


def test_key_report(table):
    report = quality.key_report({"t": (table, "k"), "empty": (table.where("false"), "k")})
    assert {tuple(r) for r in report.collect()} == {("t", 5, 2, 2), ("empty", 0, 0, 0)}


def test_null_fractions(table):
    report = quality.null_fraction_report(table, {"k": 0.3, "v": 0.2})
    assert {tuple(r) for r in report.collect()} == {("k", 0.4, 0.3, False), ("v", 0.2, 0.2, True)}


@pytest.mark.parametrize(
    "kept, expected", [(100, (100, 100, 0.0, True)), (98, (100, 98, 0.02, True)), (97, (100, 97, 0.03, False))]
)
def test_row_count_tolerance(spark, kept, expected):
    report = quality.row_count_tolerance(spark.range(100), spark.range(kept), 0.02)
    assert tuple(report.first()) == expected


def test_tolerance_of_an_empty_source(spark):
    report = quality.row_count_tolerance(spark.range(0), spark.range(1), 0.02)
    assert tuple(report.first()) == (0, 1, None, False)


def test_range_violations(table):
    report = quality.range_violations(table, QualityLimits(ranges={"v": (0.0, 2.0)}))
    assert tuple(report.first()) == ("v", 0.0, 2.0, 2)


def test_required_tables(table):
    quality.require_filled(quality.critical_nulls(table.na.drop(), ["k", "v"]))
    with pytest.raises(quality.QualityError, match="2 null values in k_nulls"):
        quality.require_filled(quality.critical_nulls(table, ["k"]))
    with pytest.raises(quality.QualityError, match="t: 2 null values"):
        quality.require_filled(quality.key_report({"t": (table, "k")}))
    with pytest.raises(quality.QualityError, match="empty"):
        quality.require_filled(quality.critical_nulls(table.where("false"), ["k"]))

"""Hot keys: the results equal plain joins and brute force, and the rows really spread out."""

import random
from collections import Counter

import pytest

from loanrisk.config import SkewConfig
from loanrisk.operators.append import append_new_loans, new_rows
from loanrisk.operators.skew import SLICE, SLICES, hot_keys, repeat_per_slice, scatter

SMALL = SkewConfig(slice_rows=50)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows belong to member 0, a few to nobody."""
    rng = random.Random(3)
    data = [
        (i, None if i % 97 == 0 else 0 if rng.random() < 0.34 else rng.randrange(1, 200))
        for i in range(4000)
    ]
    return spark.createDataFrame(data, "loan_id int, member_id int")


@pytest.fixture(scope="module")
def members(spark):
    return spark.createDataFrame([(m, f"name {m}") for m in range(0, 200) if m % 5 != 4], "member_id int, name string")


def test_hot_keys(facts):
    counts = Counter(r.member_id for r in facts.collect() if r.member_id is not None)
    hot = {r.member_id: r[SLICES] for r in hot_keys(facts, "member_id", SMALL).collect()}
    assert hot == {m: -(-n // 50) for m, n in counts.items() if n > 50}
    assert 0 in hot


@pytest.mark.parametrize("most", [1, 2, 3, 10, 150])
def test_the_hot_list_is_bounded_and_holds_the_largest_keys(facts, most):
    hot = hot_keys(facts, "member_id", SkewConfig(slice_rows=1, max_hot_keys=most)).collect()
    counts = Counter(r.member_id for r in facts.collect() if r.member_id is not None)
    assert len(hot) < most or most == 1
    assert {r.member_id for r in hot} == {m for m, n in counts.items() if n > sum(counts.values()) / most}


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("config", [SkewConfig(), SMALL, SkewConfig(slice_rows=3, max_hot_keys=2)])
def test_sliced_join_equals_plain_join(facts, members, how, config):
    hot = hot_keys(facts, "member_id", config)
    joined = (
        scatter(facts, hot, "member_id", "loan_id")
        .join(repeat_per_slice(members, hot, "member_id"), ["member_id", SLICE], how)
        .drop(SLICE)
    )
    assert rows(joined) == rows(facts.join(members, "member_id", how))


def test_a_hot_key_is_spread_over_its_slices(facts):
    hot = hot_keys(facts, "member_id", SMALL)
    slices = Counter(
        r[SLICE] for r in scatter(facts, hot, "member_id", "loan_id").where("member_id = 0").collect()
    )
    total = sum(slices.values())
    assert len(slices) == -(-total // 50)
    assert max(slices.values()) < 2 * 50


def test_rows_without_a_key_are_spread(facts):
    hot = hot_keys(facts, "member_id", SMALL)
    keyless = scatter(facts, hot, "member_id", "loan_id").where("member_id IS NULL").collect()
    assert len({r[SLICE] for r in keyless}) > len(keyless) / 2


@pytest.mark.parametrize("config", [SkewConfig(), SkewConfig(slice_rows=20), SkewConfig(slice_rows=1, max_hot_keys=4)])
def test_append_against_brute_force(spark, config):
    rng = random.Random(11)
    held = [(None if rng.random() < 0.3 else str(rng.randrange(60)), i) for i in range(400)]
    held += [("hot-known", 0)] * 200
    batch = [(None if rng.random() < 0.3 else str(rng.randrange(120)), i) for i in range(400)]
    # identical copies of two hot ids, one of them known
    batch += [("hot-known", 1)] * 300 + [("hot-new", 1)] * 300
    known = {k for k, _ in held}
    expected = [(k, v) for k, v in batch if k is None or k not in known]
    schema = "id string, v int"
    existing, incoming = spark.createDataFrame(held, schema), spark.createDataFrame(batch, schema)
    assert rows(new_rows(existing, incoming, "id", config)) == sorted(expected, key=str)
    assert rows(append_new_loans(existing, incoming, "id", config)) == sorted(held + expected, key=str)


def test_append_to_an_empty_table(spark):
    schema = "id string, v int"
    batch = spark.createDataFrame([("a", 1), (None, 2), ("a", 3)], schema)
    assert rows(append_new_loans(spark.createDataFrame([], schema), batch)) == rows(batch)


def test_missing_ids_do_not_reach_the_join(spark):
    schema = "id string, v int"
    batch = spark.createDataFrame([(None, 1)] * 10 + [("a", 1)], schema)
    plan = new_rows(spark.createDataFrame([("a", 1)], schema), batch)._jdf.queryExecution().optimizedPlan()
    anti = plan.toString().split("Join LeftAnti")[1]
    assert "isnotnull" in anti

import hashlib
import random

from pyspark.sql import functions as F

from loanrisk.operators import keys
from loanrisk.sources.raw_schema import RAW_LOAN_SCHEMA


def raw_rows(spark, *records):
    """Raw records given by name; everything else is null."""
    names = RAW_LOAN_SCHEMA.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], RAW_LOAN_SCHEMA)


def test_member_id_is_the_hash_of_the_joined_text(spark):
    df = raw_rows(
        spark,
        {"emp_title": "Nurse", "annual_inc": 75000.0, "grade": "A", "zip_code": "100xx"},
        {"annual_inc": 12_000_000.0},
        {},
    )
    expected = [
        "Nurse||__NULL__||__NULL__||75000.0||100xx||__NULL__||A||__NULL__||__NULL__",
        "||".join(["__NULL__"] * 3 + ["1.2E7"] + ["__NULL__"] * 5),
        "||".join(["__NULL__"] * 9),
    ]
    found = [r["member_id"] for r in keys.add_member_id(df).select("member_id").collect()]
    assert found == [hashlib.sha256(t.encode()).hexdigest() for t in expected]


def brute_force(rows):
    """Highest v per key (null lowest), then smallest a, then smallest b (null smallest)."""
    best = {}
    for k, v, a, b in rows:
        rank = (v is None, -(v or 0), a is not None, a or 0, b is not None, b or "")
        if k not in best or rank < best[k][0]:
            best[k] = (rank, (k, v, a, b))
    return sorted((row for _, row in best.values()), key=str)


def test_dedup_is_the_same_for_any_order_and_partitioning(spark):
    rng = random.Random(7)
    rows = [
        # one key in three rows is the same
        (0 if rng.random() < 0.34 else rng.randrange(40),
         rng.choice([None, 1.0, 2.0, 3.0]), rng.choice([None, 1, 2]), rng.choice([None, "x", "y"]))
        for _ in range(3000)
    ]
    expected = brute_force(rows)
    for parts in (1, 8):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "k int, v double, a int, b string").repartition(parts)
        found = keys.dedup_by_key(df, ["k"], "v", tie_breakers=["a"])
        assert found.columns == ["k", "v", "a", "b"]
        assert sorted((tuple(r) for r in found.collect()), key=str) == expected


def test_dedup_ascending_puts_nulls_first(spark):
    df = spark.createDataFrame([(1, 5.0), (1, None), (1, 2.0), (2, 9.0), (2, 3.0)], "k int, v double")
    found = keys.dedup_by_key(df, ["k"], "v", ascending=True)
    assert sorted(tuple(r) for r in found.collect()) == [(1, None), (2, 3.0)]


def test_dedup_drops_rows_of_a_key_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = keys.dedup_by_key(df, ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_packed_keys_come_back_and_stay_apart(spark):
    texts = [None, "", "m1", "abc", "ab", "AB" * 32, "ab" * 32, "0" * 64, "z" * 64, "ab" * 31 + "a", "x" * 31,
             "\x00" * 32, "é" * 16, " " + "a" * 63]
    df = spark.createDataFrame([(t,) for t in texts], "k string").select("k", keys.packed_key("k").alias("p"))
    rows = df.select("k", "p", keys.unpacked_key("p").alias("back")).collect()
    assert all(r["k"] == r["back"] for r in rows)
    packed = [bytes(r["p"]) for r in rows if r["p"] is not None]
    assert len(set(packed)) == len(packed) == len(texts) - 1
    assert {r["k"] for r in rows if r["p"] is not None and len(r["p"]) == 32} == {"ab" * 32, "0" * 64}

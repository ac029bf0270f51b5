"""Every registered query against its SQL on the same Parquet tables."""

import math
import os

import duckdb
import pytest

from loanrisk.checks.oracle import ORACLES
from loanrisk.checks.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    yield con
    con.close()


def _kind(value):
    return "float" if isinstance(value, float) else type(value).__name__


def _normal(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def _table(columns, rows):
    """Columns by name, rows in a fixed order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    kept = [tuple(_normal(row[i]) for i in order) for row in rows]
    kept.sort(key=lambda row: [(v is not None, _kind(v), str(v)) for v in row])
    return [columns[i] for i in order], kept


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert slow not in plan
    ours = _table(df.columns, [tuple(row) for row in df.collect()])
    result = duck.execute(ORACLES[name])
    theirs = _table([d[0] for d in result.description], result.fetchall())
    assert ours[0] == theirs[0]
    assert len(ours[1]) == len(theirs[1])
    assert ours[1], "an empty result proves nothing"
    for mine, other in zip(ours[1], theirs[1]):
        assert mine == other
        assert [_kind(v) for v in mine] == [_kind(v) for v in other]

"""Every check query against its SQL in DuckDB on the smallest tables, and the shape of the plans."""

import datetime as dt
from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from ringledger.checks import ORACLES, QUERIES

FOLDER = Path("/root/testdata/sf0.001")
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not there")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    return value.isoformat() if isinstance(value, (dt.date, dt.datetime)) else value


def canonical(columns, data):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, str(FOLDER))
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert {c: TYPES[t] for c, t in df.dtypes} == {c[0]: str(c[1]) for c in result.description}
    assert canonical(df.columns, df.collect()) == canonical(columns, result.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


def test_flagship(spark):
    assert entry_points.entry(spark).columns == ["event_name", "kind", "text"]
    assert not entry_points.entry(spark).isEmpty()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_product_and_no_python_in_the_plan(spark, name):
    plan = QUERIES[name](spark, str(FOLDER))._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas"):
        assert operator not in plan

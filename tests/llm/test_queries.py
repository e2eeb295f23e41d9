import duckdb
import pytest

from ringledger.llm import ORACLES, QUERIES
from tests.llm import plain


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS FROM '{plain.SMALL}/{t}.parquet'")
    df = QUERIES[name](spark, plain.SMALL)
    sql = con.execute(ORACLES[name])
    assert [c[0] for c in sql.description] == df.columns
    assert plain.rows(df) == sorted(sql.fetchall(), key=repr)

"""Registration of check queries."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function name, together with the SQL that must give the same rows."""

    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        ORACLES[query.__name__] = sql
        return query

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")

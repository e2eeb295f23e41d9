"""Connected components over a table of links, by rounds of joins; nothing but counts reaches the driver."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringledger.llm.common import stored


def components(pairs: DataFrame, nodes: DataFrame, key: str, value: str) -> DataFrame:
    """(key, component_id) of each node: the smallest `value` in its component.

    `pairs` has the columns a, b (keys), `nodes` one row per key. Each round links every neighbour of a node to the
    smallest neighbour: first the larger neighbours, then the smaller ones, until the links are stars. The links of a
    node are never gathered in one place: its smallest neighbour is an aggregate, stored and joined back to the links, so
    that Spark can split the links of a node that has very many. The number of rounds grows with the logarithm of the
    longest chain; each round's links are a table in the shared folder.
    """
    spark = nodes.sparkSession
    edges = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stored(spark, both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
        large = stored(spark, large.distinct())
        low = stored(spark, large.groupBy("a").agg(F.min("b").alias("low")))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
        small = small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        after = stored(spark, small.union(low.select("a", F.col("low").alias("b"))).distinct())
        sign = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        edges = after
        if sign == before:
            break
        before = sign
    head = nodes.join(edges.select(F.col("a").alias(key), F.col("b").alias("head")), key, "left")
    head = head.select(key, value, F.coalesce("head", key).alias("head"))
    head = stored(spark, head)
    smallest = stored(spark, head.groupBy("head").agg(F.min(value).alias("component_id")))
    return head.join(smallest, "head").select(key, "component_id")

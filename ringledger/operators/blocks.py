"""Ordered per-key state for keys of any size.

A plain window keeps all rows of a key in one task. Here a key with very many rows is cut into blocks along its ordering
position. Windows run per (key, block), and what a block needs from the earlier ones of its key comes from a table with
one row per block. The rows are shuffled once. The input is read three times, the first time when the operator is called:
give a stored table if it is expensive.

Only a key with over 1/100,000 of all rows is ever cut, so there are fewer than 100,000 such keys and fewer than 200,000
blocks of them, whatever the size of the input. The table of the large keys is therefore small enough to be broadcast.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringledger.session import shared_folder

ROWS_PER_BLOCK = 1_000_000
MOST_LARGE_KEYS = 100_000
KNOTS = 64
ACCURACY = 10_000


def large_keys(df: DataFrame, key: str, position: Column, rows_per_block: int) -> DataFrame:
    """Keys to be cut, with the number of blocks and quantiles of their positions."""
    least = F.greatest(F.lit(float(rows_per_block)), df.agg(F.count(F.lit(1)) / MOST_LARGE_KEYS).scalar())
    shares = [i / KNOTS for i in range(KNOTS + 1)]
    sizes = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.percentile_approx(position.cast("double"), shares, F.lit(ACCURACY)).alias("_knots")
    )
    return sizes.filter(F.col("_n") > least).select(key, "_knots", F.ceil(F.col("_n") / least).alias("_blocks"))


def with_block(df: DataFrame, large: DataFrame, key: str, position: Column, how: str = "left") -> DataFrame:
    """Adds `_block`, which never falls as the position rises; 0 for all rows of a key that is not large.

    Blocks are cut by the share of the key's rows that stand before a position: read from the quantiles, and between two
    of them by value. One far-off position therefore moves few rows, and rows of one position stay together.
    """
    at = position.cast("double")
    below = F.size(F.filter("_knots", lambda k: k <= at))
    low, high = F.get("_knots", below - 1), F.get("_knots", below)
    share = F.when(below > KNOTS, 1.0).when(below < 1, 0.0).otherwise((below - 1 + (at - low) / (high - low)) / KNOTS)
    number = F.least(F.floor(share * F.col("_blocks")), F.col("_blocks") - 1).cast("bigint")
    block = F.coalesce(number, F.lit(0).cast("bigint"))
    return df.join(F.broadcast(large), key, how).withColumn("_block", block).drop("_knots", "_blocks")


def _running(
    df: DataFrame,
    keys: Sequence[str],
    position: Column,
    order: Sequence[str],
    name: str,
    value: Column,
    rows_per_block: int,
    in_block: Column,
    of_block: Column,
    of_earlier: Callable[[Column], Column],
    combine: Callable[[Column, Column], Column],
) -> DataFrame:
    # one struct key, so that rows with NULL keys meet their own state in the joins
    keyed = df.select("*", value.alias(name), F.struct(*keys).alias("_key"))
    # stored, since both uses have to cut alike and quantiles may come out otherwise when they are computed again
    spark, path = df.sparkSession, shared_folder(df.sparkSession)
    large = large_keys(keyed, "_key", position, rows_per_block)
    large.write.parquet(path)
    large = spark.read.schema(large.schema).parquet(path)
    earlier = Window.partitionBy("_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = with_block(keyed, large, "_key", position, "inner").groupBy("_key", "_block").agg(of_block.alias("_end"))
    carried = blocks.select("_key", "_block", of_earlier(F.col("_end")).over(earlier).alias("_carried"))
    here = Window.partitionBy("_key", "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        with_block(keyed, large, "_key", position)
        .withColumn(name, in_block.over(here))
        # the rows are partitioned by these columns already, so that they are not shuffled again if `carried` is large
        .join(carried, ["_key", "_block"], "left")
        .withColumn(name, combine(F.col(name), F.col("_carried")))
        .select(*df.columns, name)
    )


def carry_forward(
    df: DataFrame,
    value: Column,
    keys: Sequence[str],
    position: Column,
    order: Sequence[str],
    name: str,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Last non-NULL value up to each row. `order` must rise with the whole-number `position`."""
    given = F.when(F.col(name).isNotNull(), F.struct(*order))
    return _running(
        df,
        keys,
        position,
        order,
        name,
        value,
        rows_per_block,
        in_block=F.last(name, ignorenulls=True),
        of_block=F.max_by(F.col(name), given),
        of_earlier=lambda end: F.last(end, ignorenulls=True),
        combine=lambda here, carried: F.coalesce(here, carried),
    )


def running_sum(
    df: DataFrame,
    value: Column,
    keys: Sequence[str],
    position: Column,
    order: Sequence[str],
    name: str,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Sum of a whole-number value up to and including each row. `order` must rise with the whole-number `position`."""
    return _running(
        df,
        keys,
        position,
        order,
        name,
        value.cast("bigint"),
        rows_per_block,
        in_block=F.sum(name),
        of_block=F.sum(name),
        of_earlier=F.sum,
        combine=lambda here, carried: here + F.coalesce(carried, F.lit(0)),
    )

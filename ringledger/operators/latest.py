"""Latest rows: overall, per key, and the last few per key."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringledger.values import SUBSCRIBE


def top_row(df: DataFrame, by: str, ties: Sequence[str]) -> DataFrame:
    """The row with the greatest `by`, smallest `ties` first; rows without `by` never win."""
    return df.filter(F.col(by).isNotNull()).orderBy(F.desc(by), *ties).limit(1)


def last_value(df: DataFrame, value: str, order: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Value of the last row, overall or per key.

    An aggregate, so every task sends one candidate per key and a key with very many rows costs no more.
    """
    return df.groupBy(*keys).agg(F.max_by(F.col(value), F.struct(*order)).alias(value))


def newest_slice(df: DataFrame, run: str) -> DataFrame:
    """Rows of the greatest `run` that has rows. On a table partitioned by it, the other slices are not read."""
    return df.filter(F.col(run) == df.agg(F.max(run)).scalar())


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Whole latest row of each key, by aggregate for the reason given in `last_value`."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def last_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """Up to `n` last rows of each key, numbered from the newest in `back`.

    Spark turns the rank filter into a limit per group ahead of the shuffle, so a task sends at most `n` rows of
    any one key.
    """
    newest_first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("back", F.row_number().over(newest_first)).filter(F.col("back") <= n)


def ever_subscribed(actions: DataFrame, user: str, action: str, wanted: str = SUBSCRIBE) -> DataFrame:
    """Users with at least one subscribe action, including those who left later."""
    return actions.filter(F.col(action) == wanted).select(user).distinct()


def current_subscribers(
    actions: DataFrame, user: str, action: str, order: Sequence[str], wanted: str = SUBSCRIBE
) -> DataFrame:
    """Users whose latest action is to subscribe. Repeated rows of one action do not change the result."""
    last = last_value(actions.filter(F.col(user).isNotNull()), action, order, [user])
    return last.filter(F.col(action) == wanted).select(user)

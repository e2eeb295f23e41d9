"""Joins of the statistics and report jobs."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_join(left: DataFrame, right: DataFrame, keys: Sequence[str], null_matches_null: bool = False) -> DataFrame:
    """All left rows with the right side's other columns. NULL keys meet each other only on request."""
    if not null_matches_null:
        return left.join(right, list(keys), "left")
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    joined = left.join(renamed, condition, "left")
    return joined.drop(*[f"_r_{k}" for k in keys])


def rows_of_one(df: DataFrame, key: str, one_row: DataFrame, value: str) -> DataFrame:
    """Rows whose key equals the value of a one-row DataFrame: a filter by scalar, without a shuffle of `df`."""
    return df.filter(F.col(key) == one_row.select(value).scalar())


def fan_out(recipients: DataFrame, messages: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per recipient and message, holding the message's keys only.

    Messages are the few of one report, and their keys pass through a scalar; texts are stored once and joined by
    `with_text` when they are delivered.
    """
    ids = messages.agg(F.collect_set(F.struct(*keys))).scalar()
    return recipients.select("*", F.explode(ids).alias("_message")).select(*recipients.columns, "_message.*")


def with_text(outbox: DataFrame, messages: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of an outbox with the texts of their messages."""
    return outbox.join(messages, list(keys))


def latest_match(
    dim: DataFrame, dim_key: Column, facts: DataFrame, fact_key: str, take: str, order: Sequence[str], how: str = "inner"
) -> DataFrame:
    """For each dimension row, one column of its latest fact row. Facts are reduced to a row per key first."""
    latest = facts.groupBy(F.col(fact_key).alias("_fk")).agg(F.max_by(F.col(take), F.struct(*order)).alias(take))
    return dim.withColumn("_dk", dim_key).join(latest, F.col("_dk") == F.col("_fk"), how).drop("_dk", "_fk")


def champions(fighters: DataFrame, title_fights: DataFrame, order: Sequence[str]) -> DataFrame:
    """Current champions with the class of their latest title fight; NULL if none is stored.

    `title_fights` has one row per side, as `two_sides` gives, of championship fights only.
    """
    holders = fighters.filter(F.col("belt") == "Yes").select(
        F.concat_ws(" ", "first_name", "last_name").alias("champion")
    )
    return latest_match(holders, F.col("champion"), title_fights, "fighter", "weight_class", order, "left").select(
        "champion", F.col("weight_class").alias("division")
    )


def closest_names(names: DataFrame, name: str, asked: Sequence[str]) -> DataFrame:
    """For each asked text, the stored name with the smallest edit distance, smallest name first.

    One scan and a partial aggregate per task, for any number of stored names.
    """
    distance = {w: F.levenshtein(F.col(name), F.lit(w)) for w in asked}
    best = [
        F.struct(
            F.lit(w).alias("asked"),
            F.min(F.struct(d.alias("distance"), F.col(name).alias("name"))).alias("best"),
        )
        for w, d in distance.items()
    ]
    found = names.filter(F.col(name).isNotNull()).agg(F.array(*best).alias("found"))
    return found.select(F.explode("found").alias("f")).select(
        "f.asked", F.col("f.best.name").alias("closest"), F.col("f.best.distance").alias("distance")
    )

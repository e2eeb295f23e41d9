"""Records and statistics per fighter."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringledger.functions.decode import landed_attempted
from ringledger.schemas import PAIR_STATS
from ringledger.values import NO_CONTEST


def two_sides(df: DataFrame, first: str, second: str, result: str, keep: Sequence[str]) -> DataFrame:
    """One row per side: fighter, opponent and outcome ('win', 'loss', or 'nc' if the result names neither)."""

    def side(me: str, other: str) -> Column:
        outcome = (
            F.when(F.col(result) == F.col(me), "win").when(F.col(result) == F.col(other), "loss").otherwise(NO_CONTEST)
        )
        return F.struct(F.col(me).alias("fighter"), F.col(other).alias("opponent"), outcome.alias("outcome"))

    sides = F.explode(F.array(side(first, second), side(second, first))).alias("side")
    return df.select(*keep, sides).select(*keep, "side.*")


def record(sides: DataFrame, who: str = "fighter", outcome: str = "outcome") -> DataFrame:
    """Wins, losses and bouts without a winner."""
    return sides.groupBy(who).agg(
        F.count_if(F.col(outcome) == "win").alias("wins"),
        F.count_if(F.col(outcome) == "loss").alias("losses"),
        F.count_if(F.col(outcome) == NO_CONTEST).alias("no_contests"),
    )


def last_fight(sides: DataFrame, events: DataFrame) -> DataFrame:
    """Latest fight of each fighter by event date, then fight number. Undated events do not count."""
    dated = events.filter(F.col("date").isNotNull()).groupBy("event_name").agg(F.max("date").alias("date"))
    rows = sides.join(dated, "event_name")
    rest = [c for c in rows.columns if c != "fighter"]
    latest = rows.groupBy("fighter").agg(
        F.max_by(F.struct(*rest), F.struct("date", "fight_id", "event_name")).alias("_row")
    )
    return latest.select("fighter", "_row.*")


def pair_violations(stats: DataFrame, keys: Sequence[str], expected: int = 2) -> DataFrame:
    """Keys that do not have exactly the expected number of rows."""
    return stats.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") != expected)


def ratio(part: Column, whole: Column, digits: int = 4) -> Column:
    """Rounded share, NULL where there is nothing to divide by."""
    return F.round(F.try_divide(part, whole), digits)


def roll_up(stats: DataFrame, keys: Sequence[str], pairs: Sequence[str] = PAIR_STATS) -> DataFrame:
    """Sums of decoded 'X of Y' columns per key: landed, attempted and their ratio."""
    decoded = stats.select(*keys, *[landed_attempted(c).alias(c) for c in pairs])
    sums = []
    for c in pairs:
        sums.append(F.sum(F.col(c)["landed"]).alias(f"{c}_landed"))
        sums.append(F.sum(F.col(c)["attempted"]).alias(f"{c}_attempted"))
    totals = decoded.groupBy(*keys).agg(*sums)
    ratios = [ratio(F.col(f"{c}_landed"), F.col(f"{c}_attempted")).alias(f"{c}_ratio") for c in pairs]
    return totals.select("*", *ratios)

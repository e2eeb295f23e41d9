"""Records, invariants and roll-ups."""

from pyspark.sql import functions as F

from ringledger.checks.registry import check, table
from ringledger.operators import records

_SIDES = """sides AS (SELECT o_orderkey, 'C' || o_custkey AS fighter, 'P' || o_orderkey % 50 AS opponent,
      CASE o_orderstatus WHEN 'F' THEN 'win' WHEN 'O' THEN 'loss' ELSE 'nc' END AS outcome FROM orders
    UNION ALL SELECT o_orderkey, 'P' || o_orderkey % 50, 'C' || o_custkey,
      CASE o_orderstatus WHEN 'O' THEN 'win' WHEN 'F' THEN 'loss' ELSE 'nc' END FROM orders)"""


def _bouts(spark, d):
    """Orders as fights: customer against a counter number, decided by the order status."""
    first = F.concat(F.lit("C"), "o_custkey")
    second = F.concat(F.lit("P"), F.col("o_orderkey") % 50)
    status = F.col("o_orderstatus")
    return table(spark, d, "orders").select(
        "o_orderkey",
        "o_orderdate",
        first.alias("fighter_1"),
        second.alias("fighter_2"),
        F.when(status == "F", first).when(status == "O", second).otherwise("nc").alias("fight_result"),
    )


def _sides(spark, d, keep=("o_orderkey",)):
    return records.two_sides(_bouts(spark, d), "fighter_1", "fighter_2", "fight_result", keep)


@check(f"WITH {_SIDES} SELECT * FROM sides")
def unpivot_sides(spark, d):
    return _sides(spark, d)


@check(
    f"""WITH {_SIDES} SELECT fighter, count(*) FILTER (outcome = 'win') AS wins,
    count(*) FILTER (outcome = 'loss') AS losses, count(*) FILTER (outcome = 'nc') AS no_contests
    FROM sides GROUP BY fighter"""
)
def record_per_entity(spark, d):
    return records.record(_sides(spark, d))


@check(
    f"""WITH {_SIDES} SELECT DISTINCT ON (fighter) fighter, o_orderkey AS fight_id, o_orderdate::DATE AS date,
    opponent, outcome FROM sides JOIN orders USING (o_orderkey) ORDER BY fighter, o_orderdate DESC, o_orderkey DESC"""
)
def last_fact_per_entity(spark, d):
    bouts = _bouts(spark, d)
    name = F.date_format("o_orderdate", "yyyy-MM-dd")
    events = bouts.select(name.alias("event_name"), F.to_date("o_orderdate").alias("date"))
    sides = records.two_sides(
        bouts.select("*", name.alias("event_name"), F.col("o_orderkey").alias("fight_id")),
        "fighter_1",
        "fighter_2",
        "fight_result",
        ["event_name", "fight_id"],
    )
    return records.last_fight(sides, events).select("fighter", "fight_id", "date", "opponent", "outcome")


@check(
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber
    HAVING count(*) <> 2"""
)
def pair_invariant(spark, d):
    return records.pair_violations(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


_PAIR = "sum(l_quantity)::BIGINT AS strikes_landed, sum(l_quantity + l_linenumber)::BIGINT AS strikes_attempted"


@check(
    f"""SELECT *, round(strikes_landed / strikes_attempted, 4) AS strikes_ratio FROM
    (SELECT l_suppkey, l_returnflag, {_PAIR} FROM lineitem GROUP BY l_suppkey, l_returnflag)"""
)
def stat_rollup(spark, d):
    landed = F.col("l_quantity").cast("bigint")
    stats = table(spark, d, "lineitem").select(
        "l_suppkey", "l_returnflag", F.concat(landed, F.lit(" of "), landed + F.col("l_linenumber")).alias("strikes")
    )
    return records.roll_up(stats, ["l_suppkey", "l_returnflag"], ["strikes"])

"""Report lines, texts and messages, with orders in the place of fights and customers in the place of events."""

from pyspark.sql import functions as F

from ringledger.checks.registry import check, table
from ringledger.operators import report
from ringledger.plans.report import deliveries, latest_report, stored_outbox
from ringledger.session import shared_folder

# orders as fights
_FIGHTS = """fights AS (SELECT c_name AS event_name, o_orderkey AS fight_id, 'Red ' || o_custkey AS fighter_1,
      'Blue ' || o_orderkey % 9 AS fighter_2,
      CASE o_orderstatus WHEN 'F' THEN 'Red ' || o_custkey WHEN 'O' THEN 'Blue ' || o_orderkey % 9 ELSE 'nc' END
        AS fight_result,
      CASE WHEN o_orderkey % 5 = 0 THEN 'Open Weight' ELSE substr(o_orderpriority, 3) END AS weight_class,
      'KO' AS method, CASE WHEN o_orderkey % 2 = 0 THEN 'Punches' ELSE '' END AS description,
      (o_orderkey % 5 + 1)::INT AS round, '3:' || (10 + o_orderkey % 50) AS time,
      (o_orderkey % 3 = 0)::INT AS championship_fight, (o_totalprice > 300000)::INT AS performance_of_the_night,
      (o_totalprice > 400000)::INT AS ko_of_the_night, (o_totalprice < 100000)::INT AS sub_of_the_night,
      o_orderdate FROM orders JOIN customer ON o_custkey = c_custkey)"""

_WINNER = "CASE fight_result WHEN fighter_1 THEN fighter_1 WHEN fighter_2 THEN fighter_2 END"
_LOSER = "CASE fight_result WHEN fighter_1 THEN fighter_2 WHEN fighter_2 THEN fighter_1 END"
_TITLE = """CASE WHEN championship_fight = 1 AND weight_class = 'Open Weight' THEN 'UFC Championship'
      WHEN championship_fight = 1 THEN weight_class || ' Championship Fight' END"""
_LINE = f"""weight_class || ' - Winner: <b>' || coalesce({_WINNER}, 'None') || '</b> | Loser: '
      || coalesce({_LOSER}, 'None') || ' | ' || method
      || CASE WHEN description <> '' THEN ' (' || description || ')' ELSE '' END || ' R' || round || ' @ ' || time
      || coalesce(' - ' || {_TITLE}, '')"""
_AWARDS = """awards AS (SELECT event_name, fight_id, 0 AS type_no, 'Performance of the Night' AS type,
      fighter_1 || ' vs ' || fighter_2 AS matchup FROM fights WHERE performance_of_the_night = 1
    UNION ALL SELECT event_name, fight_id, 1, 'KO of the Night', fighter_1 || ' vs ' || fighter_2 FROM fights
      WHERE ko_of_the_night = 1
    UNION ALL SELECT event_name, fight_id, 2, 'Submission of the Night', fighter_1 || ' vs ' || fighter_2 FROM fights
      WHERE sub_of_the_night = 1)"""


def _fights(spark, d):
    key, price, status = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_orderstatus")
    red, blue = F.concat(F.lit("Red "), "o_custkey"), F.concat(F.lit("Blue "), key % 9)
    names = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("event_name"))
    return (
        table(spark, d, "orders")
        .join(names, "o_custkey")
        .select(
            "event_name",
            key.alias("fight_id"),
            red.alias("fighter_1"),
            blue.alias("fighter_2"),
            F.when(status == "F", red).when(status == "O", blue).otherwise("nc").alias("fight_result"),
            F.when(key % 5 == 0, "Open Weight").otherwise(F.expr("substr(o_orderpriority, 3)")).alias("weight_class"),
            F.lit("KO").alias("method"),
            F.when(key % 2 == 0, "Punches").otherwise("").alias("description"),
            (key % 5 + 1).cast("int").alias("round"),
            F.concat(F.lit("3:"), key % 50 + 10).alias("time"),
            (key % 3 == 0).cast("int").alias("championship_fight"),
            (price > 300000).cast("int").alias("performance_of_the_night"),
            (price > 400000).cast("int").alias("ko_of_the_night"),
            (price < 100000).cast("int").alias("sub_of_the_night"),
            "o_orderdate",
        )
    )


def _events(spark, d):
    last = table(spark, d, "orders").groupBy("o_custkey").agg(F.to_date(F.max("o_orderdate")).alias("date"))
    c = table(spark, d, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return c.join(last, "o_custkey").select(
        F.col("c_name").alias("event_name"), "date", F.col("c_mktsegment").alias("location")
    )


@check(f"WITH {_FIGHTS} SELECT event_name, fight_id, {_WINNER} AS winner, {_LOSER} AS loser FROM fights")
def case_winner_loser(spark, d):
    names = [F.col("fight_result"), F.col("fighter_1"), F.col("fighter_2")]
    return _fights(spark, d).select(
        "event_name", "fight_id", report.winner(*names).alias("winner"), report.loser(*names).alias("loser")
    )


@check("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE 'nc' END AS result FROM orders")
def result_from_flag(spark, d):
    flag = F.when(F.col("o_orderstatus") == "F", "win").otherwise(F.lower("o_orderstatus"))
    result = report.result_from_flag(flag, F.col("o_orderpriority"))
    return table(spark, d, "orders").select("o_orderkey", result.alias("result"))


@check(f"WITH {_FIGHTS} SELECT event_name, fight_id, {_TITLE} AS title FROM fights")
def case_title(spark, d):
    title = report.title(F.col("championship_fight"), F.col("weight_class")).alias("title")
    return _fights(spark, d).select("event_name", "fight_id", title)


@check(f"WITH {_FIGHTS} SELECT event_name, fight_id, {_LINE} AS line FROM fights")
def report_lines(spark, d):
    return report.card_lines(_fights(spark, d))


@check(
    f"""WITH {_FIGHTS} SELECT event_name, string_agg({_LINE}, chr(10) || chr(10) ORDER BY fight_id DESC) AS card
    FROM fights GROUP BY event_name"""
)
def report_card_text(spark, d):
    lines = report.card_lines(_fights(spark, d))
    return report.joined_lines(lines, ["event_name"], "line", "\n\n", "fight_id DESC", "card")


@check(f"WITH {_FIGHTS}, {_AWARDS} SELECT type, matchup FROM awards")
def highlight_union(spark, d):
    f = _fights(spark, d)
    tags = [(F.col(flag) == 1, text) for flag, text in report.AWARDS]
    return report.tagged_by_union(f, tags, report.matchup(F.col("fighter_1"), F.col("fighter_2")))


@check(f"WITH {_FIGHTS}, {_AWARDS} SELECT event_name, fight_id, type, matchup FROM awards")
def highlight_stack(spark, d):
    return report.awards(_fights(spark, d)).select("event_name", "fight_id", "type", "matchup")


_MESSAGES = f"""{_FIGHTS}, {_AWARDS},
    event AS (SELECT c_name AS event_name, c_mktsegment AS location, max(o_orderdate)::DATE AS date
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL ORDER BY date DESC, event_name LIMIT 1),
    card AS (SELECT string_agg({_LINE}, chr(10) || chr(10) ORDER BY fight_id DESC) AS t
      FROM fights WHERE event_name = (SELECT event_name FROM event)),
    won AS (SELECT string_agg(CASE type_no
      WHEN 0 THEN 'Performance Of The Night' WHEN 1 THEN 'Ko Of The Night' ELSE 'Submission Of The Night' END
      || ': ' || matchup, chr(10) ORDER BY type_no, fight_id) AS t
      FROM awards WHERE event_name = (SELECT event_name FROM event)),
    messages AS (SELECT event_name, 1 AS kind, '<b>🏟️ Last UFC Event:</b>' || chr(10) || 'Event: ' || event_name
      || chr(10) || 'Location: ' || location || chr(10) || 'Date: ' || date AS text FROM event
    UNION ALL SELECT event_name, 2, '<b>🥊 Fight Card Results:</b>' || chr(10) || coalesce(t, '') FROM event, card
    UNION ALL SELECT event_name, 3, '<b>🏆 Event Highlights:</b>' || chr(10) || t FROM event, won WHERE t IS NOT NULL)"""


@check(f"WITH {_MESSAGES} SELECT event_name, kind, text FROM messages")
def latest_entity_report(spark, d):
    return latest_report(_events(spark, d), _fights(spark, d))


@check(
    f"""WITH {_MESSAGES} SELECT user_id::VARCHAR AS user_id, event_name, kind, text
    FROM (SELECT DISTINCT user_id FROM events WHERE event_type = 'signup'), messages"""
)
def report_outbox(spark, d):
    """Recipients with the keys of the messages, and the texts joined from their one copy."""
    users = table(spark, d, "events").filter("event_type = 'signup'").select(F.col("user_id").cast("string")).distinct()
    path = shared_folder(spark)
    box = stored_outbox(spark, users, latest_report(_events(spark, d), _fights(spark, d)), path)
    return deliveries(box, spark.read.parquet(path))

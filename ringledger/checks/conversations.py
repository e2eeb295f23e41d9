"""Conversation context and per-user running state."""

from pyspark.sql import functions as F

from ringledger.checks.registry import check, table
from ringledger.operators import conversation
from ringledger.session import shared_folder
from ringledger.sources import tables


def _micros():
    return F.unix_micros(F.col("ts").cast("timestamp"))


@check(
    """SELECT user_id, event_id, back::INT AS back FROM (SELECT user_id, event_id, row_number() OVER
    (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS back FROM events) WHERE back <= 10"""
)
def last_n_per_key(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "ts")
    return conversation.kept_messages(e, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "back")


@check(
    """SELECT conv_id, turn, back::INT AS back, '- ' || role || ': ' || left(text, 100) || '...' AS line FROM
    (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM conversations) WHERE back <= 3"""
)
def recent_turns(spark, d):
    c = table(spark, d, "conversations")
    return conversation.prompt_lines(c, ["conv_id"], ["turn"], "role", "text").select("conv_id", "turn", "back", "line")


@check(
    """SELECT conv_id, turn, text FROM (SELECT conv_id, turn, CASE WHEN turn % 3 = 1 THEN ' ' ELSE text END AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM conversations)
    WHERE back <= 5 AND trim(text) <> ''"""
)
def recent_turns_nonblank(spark, d):
    blanked = F.when(F.col("turn") % 3 == 1, " ").otherwise(F.col("text"))
    c = table(spark, d, "conversations").withColumn("text", blanked)
    return conversation.summary_messages(c, ["conv_id"], ["turn"], "text").select("conv_id", "turn", "text")


@check(
    """SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN props END IGNORE NULLS) OVER
    (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS mention FROM events"""
)
def last_mention(spark, d):
    e = table(spark, d, "events")
    named = F.when(F.col("event_type") == "purchase", F.col("props"))
    rows = conversation.last_mention(e, named, ["user_id"], _micros(), ["ts", "event_id"], rows_per_block=50)
    return rows.select("event_id", "user_id", "mention")


@check(
    """SELECT event_id, user_id, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER
    (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS session FROM events"""
)
def session_by_reset(spark, d):
    e = table(spark, d, "events")
    reset = F.col("event_type") == "signup"
    rows = conversation.sessions(e, reset, ["user_id"], _micros(), ["ts", "event_id"], rows_per_block=50)
    return rows.select("event_id", "user_id", "session")


@check(
    """WITH s AS (SELECT *, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id
      ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS session FROM events)
    SELECT user_id, session, event_id, back::INT AS back FROM (SELECT *, row_number() OVER (PARTITION BY user_id, session
      ORDER BY ts DESC, event_id DESC) AS back FROM s) WHERE back <= 10"""
)
def kept_per_session(spark, d):
    """Kept messages of every session of a user: a reset starts an empty context."""
    e = table(spark, d, "events").select("user_id", "event_id", "ts", "event_type")
    reset = F.col("event_type") == "signup"
    rows = conversation.sessions(e, reset, ["user_id"], _micros(), ["ts", "event_id"], rows_per_block=50)
    kept = conversation.kept_messages(rows, ["user_id", "session"], ["ts", "event_id"])
    return kept.select("user_id", "session", "event_id", "back")


@check(
    """SELECT c_mktsegment, arg_max(c_name, (c_acctbal, c_custkey)) AS mention FROM customer WHERE c_mktsegment = 'BUILDING'
    GROUP BY ALL"""
)
def mention_of_last_result(spark, d):
    """A question's stored result, and the name that its last row mentions."""
    spark = tables.question_session(spark)
    tables.register_views(spark, d, ["customer"], ".parquet")
    sql = "SELECT c_mktsegment, c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = :segment"
    result = tables.answer(spark, sql, shared_folder(spark), {"segment": "BUILDING"})
    mention = conversation.mention_of_result(result, ["c_acctbal", "c_custkey"])
    return result.select("c_mktsegment").distinct().withColumn("mention", mention.scalar())


@check("SELECT c_custkey, c_name AS mention FROM customer")
def mentioned_columns(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", conversation.mentioned_name(c).alias("mention"))

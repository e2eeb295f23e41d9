"""Latest rows, bookmarks, gap slices, joins and SQL access."""

from pyspark.sql import functions as F

from ringledger.checks.registry import check, table
from ringledger.operators import closest, incremental, joins, latest
from ringledger.session import shared_folder
from ringledger.sources import tables


@check("SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase' AND value > 50")
def param_filter(spark, d):
    spark = tables.question_session(spark)
    tables.register_views(spark, d, ["events"], ".parquet")
    sql = "SELECT event_id, user_id, value FROM events WHERE event_type = :kind AND value > :least"
    return tables.select(spark, sql, {"kind": "purchase", "least": 50})


@check(
    """SELECT n.n_name AS nation, count(*) AS customers, round(max(c.c_acctbal), 2) AS highest
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name"""
)
def sql_view_query(spark, d):
    spark = tables.question_session(spark)
    tables.register_views(spark, d, ["customer", "nation"], ".parquet")
    return tables.select(
        spark,
        "SELECT n.n_name AS nation, count(*) AS customers, round(max(c.c_acctbal), 2) AS highest "
        "FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name;",
    )


@check(
    """SELECT o_custkey, count(*) AS orders, max(o_orderkey) AS last_order FROM orders
    WHERE o_orderstatus = 'F' GROUP BY o_custkey HAVING count(*) >= 3"""
)
def sql_followup_view(spark, d):
    spark = tables.question_session(spark)
    tables.register_views(spark, d, ["orders"], ".parquet")
    store = shared_folder(spark)
    tables.answer(spark, "SELECT * FROM orders WHERE o_orderstatus = :status", store, {"status": "F"})
    # an empty answer leaves the last result as it is
    tables.answer(spark, "SELECT * FROM orders WHERE o_orderkey < 0", store)
    return tables.answer(
        spark,
        "SELECT o_custkey, count(*) AS orders, max(o_orderkey) AS last_order FROM last_query_result "
        "GROUP BY o_custkey HAVING count(*) >= 3",
        store,
    )


@check(
    """SELECT '{"p_partkey":' || p_partkey || ',"p_brand":"' || p_brand || '"}' AS record FROM part WHERE p_size > 40
    UNION ALL SELECT 'No results found.' WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_size > 40)"""
)
def sql_records(spark, d):
    spark = tables.question_session(spark)
    tables.register_views(spark, d, ["part"], ".parquet")
    sql = "SELECT p_partkey, p_brand FROM part WHERE p_size > :size"
    rows = tables.answer(spark, sql, shared_folder(spark), {"size": 40})
    return tables.records_or_message(rows)


@check(
    """SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id"""
)
def bookmark_last_row(spark, d):
    return latest.last_value(table(spark, d, "events"), "event_type", ["ts", "event_id"], ["user_id"])


_SINCE = """WITH m AS (SELECT arg_max(user_id, (ts, event_id)) AS mark FROM events WHERE event_type = 'error'),
    p AS (SELECT min(event_id) AS place FROM events, m WHERE user_id = mark)
    SELECT event_id, user_id FROM events, p WHERE place IS NULL OR event_id > place"""


@check(_SINCE)
def since_bookmark(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    mark = latest.last_value(e.filter("event_type = 'error'"), "user_id", ["ts", "event_id"]).scalar()
    return incremental.since_bookmark(e, "user_id", "event_id", mark).select("event_id", "user_id")


@check(
    """WITH u AS (SELECT arg_max(event_id, ts) AS hi FROM events WHERE event_type = 'purchase' AND value < 60),
    d AS (SELECT arg_min(event_id, ts) AS lo FROM events WHERE event_type = 'error' AND value > 20)
    SELECT event_id, event_type FROM events, u, d WHERE event_id > lo AND event_id <= hi"""
)
def gap_slice(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type", "ts", "value")
    done = e.filter("event_type = 'error' AND value > 20").agg(F.min_by("event_id", "ts")).scalar()
    upstream = latest.last_value(e.filter("event_type = 'purchase' AND value < 60"), "event_id", ["ts"]).scalar()
    return incremental.gap_after_done(e, "event_id", "event_id", upstream, done).select("event_id", "event_type")


@check(
    """WITH d AS (SELECT arg_min(event_id, ts) AS lo FROM events WHERE event_type = 'error' AND value > 20)
    SELECT event_id, event_type FROM events, d WHERE event_id > lo"""
)
def gap_slice_alt(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type", "ts", "value")
    upstream = e.filter("event_type = 'none'").agg(F.max("event_id")).scalar()
    done = e.filter("event_type = 'error' AND value > 20").agg(F.min_by("event_id", "ts")).scalar()
    return incremental.gap_up_to_known(e, "event_id", "event_id", upstream, done).select("event_id", "event_type")


@check(
    """SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate::DATE AS day FROM orders
    ORDER BY o_orderdate DESC, o_orderkey LIMIT 1"""
)
def top1_latest(spark, d):
    return latest.top_row(table(spark, d, "orders"), "o_orderdate", ["o_orderkey"]).select(
        "o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("day")
    )


@check(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_orderkey =
    (SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 1)"""
)
def semi_join_latest(spark, d):
    newest = latest.top_row(table(spark, d, "orders"), "o_orderdate", ["o_orderkey"])
    lines = joins.rows_of_one(table(spark, d, "lineitem"), "l_orderkey", newest, "o_orderkey")
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@check(
    """SELECT DISTINCT ON (user_id) user_id, event_id, event_type, value FROM events ORDER BY user_id, ts DESC, event_id DESC"""
)
def latest_per_key(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return latest.latest_per_key(e, ["user_id"], ["ts", "event_id"]).drop("ts")


@check("SELECT DISTINCT user_id FROM events WHERE event_type = 'signup'")
def ever_subscribed(spark, d):
    return latest.ever_subscribed(table(spark, d, "events"), "user_id", "event_type", "signup")


@check(
    """SELECT user_id FROM (SELECT DISTINCT ON (user_id) user_id, event_type FROM events ORDER BY user_id, ts DESC, event_id DESC) WHERE event_type = 'signup'"""
)
def current_subscribers(spark, d):
    """As in the stream: every action but a signup ends the subscription."""
    return latest.current_subscribers(table(spark, d, "events"), "user_id", "event_type", ["ts", "event_id"], "signup")


_A = """a AS (SELECT l_suppkey, l_returnflag, l_linestatus, sum(l_quantity) AS quantity FROM lineitem
    GROUP BY l_suppkey, l_returnflag, l_linestatus)"""


def _sums(spark, d, keys, only="l_discount > 0.05"):
    lines = table(spark, d, "lineitem")
    quantity = lines.groupBy(*keys).agg(F.sum("l_quantity").alias("quantity"))
    price = lines.filter(only).groupBy(*keys).agg(F.count(F.lit(1)).alias("discounted"))
    return quantity, price


@check(
    f"""WITH {_A}, b AS (SELECT l_suppkey, l_returnflag, l_linestatus, count(*) AS discounted FROM lineitem
      WHERE l_discount > 0.05 AND l_returnflag <> 'A' GROUP BY l_suppkey, l_returnflag, l_linestatus)
    SELECT * FROM a LEFT JOIN b USING (l_suppkey, l_returnflag, l_linestatus)"""
)
def left_join_3key(spark, d):
    keys = ["l_suppkey", "l_returnflag", "l_linestatus"]
    a, b = _sums(spark, d, keys, "l_discount > 0.05 AND l_returnflag <> 'A'")
    return joins.left_join(a, b, keys)


@check(
    """WITH a AS (SELECT l_suppkey, l_returnflag, l_linestatus, l_linenumber, sum(l_quantity) AS quantity FROM lineitem
      GROUP BY ALL),
    b AS (SELECT l_suppkey, l_returnflag, l_linestatus, l_linenumber, count(*) AS discounted FROM lineitem
      WHERE l_discount > 0.05 GROUP BY l_suppkey, l_returnflag, l_linestatus, l_linenumber)
    SELECT * FROM a LEFT JOIN b USING (l_suppkey, l_returnflag, l_linestatus, l_linenumber)"""
)
def left_join_4key(spark, d):
    keys = ["l_suppkey", "l_returnflag", "l_linestatus", "l_linenumber"]
    return joins.left_join(*_sums(spark, d, keys), keys)


@check(
    """WITH l AS (SELECT l_linenumber, CASE WHEN l_returnflag <> 'A' THEN l_returnflag END AS flag, l_quantity,
      l_discount FROM lineitem),
    a AS (SELECT l_linenumber, flag, sum(l_quantity) AS quantity FROM l GROUP BY ALL),
    b AS (SELECT l_linenumber, flag, count(*) AS discounted FROM l WHERE l_discount > 0.05 GROUP BY l_linenumber, flag)
    SELECT a.l_linenumber, a.flag, quantity, discounted FROM a LEFT JOIN b
    ON a.l_linenumber = b.l_linenumber AND a.flag IS NOT DISTINCT FROM b.flag"""
)
def left_join_null_safe(spark, d):
    lines = table(spark, d, "lineitem").withColumn("flag", F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")))
    keys = ["l_linenumber", "flag"]
    a = lines.groupBy(*keys).agg(F.sum("l_quantity").alias("quantity"))
    b = lines.filter("l_discount > 0.05").groupBy(*keys).agg(F.count(F.lit(1)).alias("discounted"))
    return joins.left_join(a, b, keys, null_matches_null=True)


@check(
    """SELECT c_custkey AS user_id, r_regionkey AS message_id, r_name AS text FROM customer, region"""
)
def fanout_outbox(spark, d):
    users = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))
    messages = table(spark, d, "region").select(F.col("r_regionkey").alias("message_id"), F.col("r_name").alias("text"))
    outbox = joins.fan_out(users, messages, ["message_id"])
    return joins.with_text(outbox, messages, ["message_id"]).select("user_id", "message_id", "text")


@check(
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN
    (SELECT user_id FROM events WHERE event_type = 'signup')"""
)
def notify_once(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    sent = table(spark, d, "events").filter("event_type = 'signup'").select(F.col("user_id").alias("o_custkey"))
    return incremental.unsent(orders, sent, "o_custkey").select("o_orderkey", "o_custkey")


@check(
    """SELECT event_id, user_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM events s WHERE s.event_type = 'signup'
    AND s.user_id = e.user_id AND s.value IS NOT DISTINCT FROM e.value)"""
)
def append_new_only(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "value", "event_type")
    stored = e.filter("event_type = 'signup'").select("user_id", "value")
    return incremental.not_yet_stored(e, stored, ["user_id", "value"]).select("event_id", "user_id")


@check(
    """SELECT c_mktsegment || ' ' || c_name AS champion, o_orderpriority AS division FROM customer LEFT JOIN
    (SELECT o_custkey, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS o_orderpriority FROM orders
      WHERE o_orderstatus = 'F' GROUP BY o_custkey) ON o_custkey = c_custkey WHERE c_acctbal > 5000"""
)
def dim_fact_latest_lookup(spark, d):
    """Customers with a high balance as champions, their orders of one status as title fights."""
    people = table(spark, d, "customer").select(
        "c_custkey",
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.when(F.col("c_acctbal") > 5000, "Yes").alias("belt"),
    )
    names = people.select("c_custkey", F.concat_ws(" ", "first_name", "last_name").alias("fighter"))
    orders = table(spark, d, "orders").filter("o_orderstatus = 'F'").withColumnRenamed("o_orderpriority", "weight_class")
    fights = orders.join(names, F.col("o_custkey") == F.col("c_custkey"))
    return joins.champions(people, fights, ["o_orderdate", "o_orderkey"])


_ASKED = ["smal rign", "blue bolts", "gren gadgt", "Large Pipe"]


@check(
    """SELECT asked, name AS closest, distance::INT AS distance FROM (
      SELECT asked, p_name AS name, levenshtein(asked, p_name) AS distance,
      row_number() OVER (PARTITION BY asked ORDER BY levenshtein(asked, p_name), p_name) AS n
      FROM (SELECT DISTINCT p_name FROM part), (VALUES ('smal rign'), ('blue bolts'), ('gren gadgt'), ('Large Pipe')) v(asked))
    WHERE n = 1"""
)
def closest_name(spark, d):
    return joins.closest_names(table(spark, d, "part"), "p_name", _ASKED)


@check(
    """WITH names AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z]{6,}')) AS name FROM documents),
    asked AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z]{6,}')) AS asked FROM benchmark)
    SELECT asked, best.name AS closest, best.distance::INT AS distance FROM (SELECT asked,
      min({'distance': levenshtein(asked, name), 'name': name}) AS best FROM asked, names GROUP BY asked)"""
)
def closest_names_of_table(spark, d):
    """The closest word of the documents for each word of the test items."""
    words = F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{6,}"), F.lit(0)))
    asked = table(spark, d, "benchmark").select(words.alias("word"))
    return closest.closest_of_table(asked, "word", table(spark, d, "documents").select(words.alias("name")), "name")

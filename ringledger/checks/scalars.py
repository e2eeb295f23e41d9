"""Column functions on whole tables: text is built from columns and decoded back."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringledger.checks.registry import check, table
from ringledger.functions import decode, text
from ringledger.sources import files
from ringledger.sources.tables import records
from ringledger.streaming.actions import encoded, parsed


@check(
    """SELECT o_orderkey, nullif(CASE WHEN o_orderstatus = 'P' THEN '---' ELSE o_orderstatus END, '---') AS status,
    CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS priority FROM orders"""
)
def null_tokens(spark, d):
    o = table(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "---").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_orderpriority") == "5-LOW", "--").otherwise(F.col("o_orderpriority")).alias("priority"),
    )
    return decode.missing_to_null(o)


@check(
    """WITH r AS (SELECT p_partkey, (p_size % 7)::VARCHAR || ''' ' || (p_size % 12)::VARCHAR
      || CASE WHEN p_size % 3 = 0 THEN '' ELSE '"' END AS h,
    CASE WHEN p_size % 5 = 0 THEN '--' WHEN p_size % 5 = 1 THEN '' ELSE p_size::VARCHAR || '""' END AS x FROM part)
    SELECT p_partkey, CASE WHEN ends_with(h, '"') THEN substr(h, 1, length(h) - 1) ELSE h END AS height,
    nullif(nullif(rtrim(x, '"'), ''), '--') AS reach FROM r"""
)
def strip_suffix(spark, d):
    size = F.col("p_size")
    raw = table(spark, d, "part").select(
        "p_partkey",
        F.concat(size % 7, F.lit("' "), size % 12, F.when(size % 3 == 0, "").otherwise('"')).alias("h"),
        F.when(size % 5 == 0, "--").when(size % 5 == 1, "").otherwise(F.concat(size, F.lit('""'))).alias("x"),
    )
    return raw.select("p_partkey", decode.drop_one_mark("h").alias("height"), decode.drop_marks("x").alias("reach"))


@check(
    """SELECT o_orderkey, array_to_string(list_transform(regexp_extract_all(
      lower(replace(o_orderstatus || '_' || o_orderpriority, '_', ' ')), '[a-z]+|[^a-z]+'),
      lambda w: upper(w[1]) || substr(w, 2)), '') AS title FROM orders"""
)
def title_case(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", text.title_case(F.concat_ws("_", "o_orderstatus", "o_orderpriority")).alias("title")
    )


@check(
    """SELECT doc_id, source AS second, lang || ',' || text AS rest FROM documents"""
)
def split_limit(spark, d):
    line = F.concat_ws(",", "doc_id", "source", "lang", "text")
    return table(spark, d, "documents").select(
        "doc_id", text.field_of_line(line, 1).alias("second"), text.field_of_line(line, 2).alias("rest")
    )


@check("SELECT conv_id, turn, '- ' || role || ': ' || left(text, 100) || '...' AS line FROM conversations")
def truncate_preview(spark, d):
    return table(spark, d, "conversations").select(
        "conv_id", "turn", text.preview(F.col("role"), F.col("text")).alias("line")
    )


@check(
    r"""SELECT doc_id, regexp_replace(regexp_replace(x, '```(?:sql)?\s*', '', 'g'), '^\s+|\s+$', '', 'g') AS sql_text
    FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text
      ELSE CASE WHEN doc_id % 3 = 1 THEN '```sql' ELSE '```' END || chr(10) || text || chr(10) || '```' END AS x
    FROM documents)"""
)
def fence_strip(spark, d):
    third = F.col("doc_id") % 3
    mark = F.when(third == 1, "```sql").otherwise("```")
    fenced = F.when(third == 0, F.col("text")).otherwise(F.concat(mark, F.lit("\n"), "text", F.lit("\n```")))
    return table(spark, d, "documents").select("doc_id", text.strip_fences(fenced).alias("sql_text"))


@check(
    """SELECT o_orderkey, strftime(o_orderdate, '%B %-d, %Y') AS long_date, o_orderdate::DATE AS order_date FROM orders"""
)
def date_text_roundtrip(spark, d):
    dated = table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "MMMM d, yyyy").alias("long_date"))
    return dated.withColumn("order_date", decode.event_date("long_date"))


@check("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS at FROM events")
def iso_format(spark, d):
    return table(spark, d, "events").select("event_id", text.iso_text(F.col("ts")).alias("at"))


@check(
    """SELECT l_orderkey, l_linenumber, l_quantity::BIGINT AS landed, (l_quantity + l_linenumber)::BIGINT AS attempted
    FROM lineitem"""
)
def pair_decode(spark, d):
    landed = F.col("l_quantity").cast("bigint")
    line = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.concat(landed, F.lit(" of "), landed + F.col("l_linenumber")).alias("pair")
    )
    return line.select("l_orderkey", "l_linenumber", decode.landed_attempted("pair").alias("p")).select(
        "l_orderkey", "l_linenumber", "p.*"
    )


@check(
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0 THEN round(l_discount * 100)::INT END AS pct
    FROM lineitem"""
)
def percent_decode(spark, d):
    shown = F.when(F.col("l_discount") > 0, F.concat(F.round(F.col("l_discount") * 100).cast("int"), F.lit("%")))
    line = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.coalesce(shown, F.lit("")).alias("t"))
    return line.select("l_orderkey", "l_linenumber", decode.percent("t").alias("pct"))


@check("SELECT event_id, (hour(ts) * 60 * 60 + minute(ts) * 60 + second(ts))::INT AS seconds FROM events")
def mmss_to_seconds(spark, d):
    minutes = F.hour("ts") * 60 + F.minute("ts")
    clock = F.concat(minutes, F.lit(":"), F.lpad(F.second("ts").cast("string"), 2, "0")).alias("clock")
    return table(spark, d, "events").select("event_id", clock).select(
        "event_id", decode.clock_seconds("clock").alias("seconds")
    )


@check(
    """SELECT p_partkey, ((p_size // 12) * 12 + p_size % 12)::INT AS inches,
    CASE WHEN p_size % 4 > 0 THEN p_size END AS pounds FROM part"""
)
def body_decode(spark, d):
    size = F.col("p_size")
    raw = table(spark, d, "part").select(
        "p_partkey",
        F.concat(F.floor(size / 12), F.lit("' "), size % 12, F.lit('"')).alias("height"),
        F.when(size % 4 == 0, "").otherwise(F.concat(size, F.lit(" lbs."))).alias("weight"),
    )
    return raw.select(
        "p_partkey", decode.height_inches("height").alias("inches"), decode.weight_pounds("weight").alias("pounds")
    )


@check("SELECT event_id, json_extract_string(props, '$.k')::INT AS k FROM events")
def json_decode_props(spark, d):
    e = table(spark, d, "events")
    return parsed(e, T.StructType.fromDDL("k int"), "props", keep=["event_id"])


@check(
    """SELECT event_id, '{"user_id":' || user_id || ',"username":"' || coalesce(CASE WHEN user_id % 2 = 0
      THEN 'u' || user_id END, '') || '","action":"' || CASE WHEN event_type = 'signup' THEN 'subscribe'
      ELSE 'unsubscribe' END || '","timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || '","subscribe":'
      || CASE WHEN event_type = 'signup' THEN '1' ELSE '0' END || '}' AS message FROM events"""
)
def json_encode_actions(spark, d):
    name = F.when(F.col("user_id") % 2 == 0, F.concat(F.lit("u"), "user_id"))
    message = encoded(F.col("user_id"), name, F.col("event_type") == "signup", text.iso_text(F.col("ts")))
    return table(spark, d, "events").select("event_id", message.alias("message"))


@check(
    """SELECT event_id, user_id::VARCHAR AS user_id, event_type AS action,
    CASE WHEN event_type = 'signup' THEN 1 END::INT AS subscribe FROM events"""
)
def json_parse_message(spark, d):
    e = table(spark, d, "events").select(
        "event_id",
        F.to_json(
            F.struct(
                "user_id", F.col("event_type").alias("action"), F.when(F.col("event_type") == "signup", 1).alias("subscribe")
            )
        ).alias("value"),
    )
    return parsed(e, keep=["event_id"]).select("event_id", "user_id", "action", "subscribe")


@check(
    """SELECT '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":' || c_nationkey
    || ',"c_mktsegment":' || CASE WHEN c_mktsegment = 'BUILDING' THEN 'null' ELSE '"' || c_mktsegment || '"' END || '}'
    AS record FROM customer"""
)
def row_to_json(spark, d):
    segment = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("c_mktsegment")
    return records(table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", segment))


@check("SELECT event_id, event_type, '2025-05-24T12:43:40.469210Z' AS last_run FROM events")
def stamp_batch(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type")
    return files.stamped(e, "last_run", "2025-05-24T12:43:40.469210Z")


@check(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_custkey::INT END AS number,
    o_orderdate::DATE AS day, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS word FROM orders"""
)
def typed_cells(spark, d):
    raw = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(F.col("o_orderstatus") == "F", "2.0").otherwise(F.col("o_custkey").cast("string")).alias("number"),
        F.date_format("o_orderdate", "MMMM d, yyyy").alias("day"),
        F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(F.col("o_orderpriority")).alias("word"),
    )
    from pyspark.sql.types import StructType

    return decode.typed(raw, StructType.fromDDL("o_orderkey bigint, number int, day date, word string"))

from pyspark.sql import functions as F

from ringledger.operators import conversation as conv
from tests.conftest import rows

SCHEMA = "user_id string, n int, role string, content string, reset boolean"


def messages(spark):
    data = [("u", i, "user" if i % 2 else "assistant", " " if i in (13, 15) else f"text {i}", i == 5) for i in range(1, 16)]
    return spark.createDataFrame([*data, ("v", 1, "user", "\n", False)], SCHEMA)


def test_kept_prompt_and_summary(spark):
    m = messages(spark)
    kept = conv.kept_messages(m, ["user_id"], ["n"]).filter("user_id = 'u'")
    assert sorted(r.n for r in kept.collect()) == list(range(6, 16))
    lines = conv.prompt_lines(m, ["user_id"], ["n"], "role", "content").filter("user_id = 'u'")
    assert [r.line for r in lines.orderBy("n").collect()] == ["- user:  ...", "- assistant: text 14...", "- user:  ..."]
    # blank messages count towards the five before they are left out
    assert rows(conv.summary_messages(m, ["user_id"], ["n"], "content").select("user_id", "n")) == [
        ("u", 11),
        ("u", 12),
        ("u", 14),
    ]


def test_limit_is_applied_before_the_shuffle(spark):
    plan = conv.kept_messages(messages(spark), ["user_id"], ["n"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_sessions_start_with_the_reset(spark):
    got = conv.sessions(messages(spark), F.col("reset"), ["user_id"], F.col("n"), ["n"], rows_per_block=3)
    by_user = {(r.user_id, r.n): r.session for r in got.collect()}
    assert [by_user["u", i] for i in range(1, 16)] == [0] * 4 + [1] * 11
    assert by_user["v", 1] == 0


def test_last_mention_is_carried_and_ends_with_the_session(spark):
    data = [("u", 1, None, False), ("u", 2, "Ann", False), ("u", 3, None, False), ("u", 4, None, True), ("u", 5, "Bea", False), ("u", 6, None, False)]
    df = spark.createDataFrame(data, "user_id string, n int, name string, reset boolean")
    s = conv.sessions(df, F.col("reset"), ["user_id"], F.col("n"), ["n"])
    got = conv.last_mention(s, F.col("name"), ["user_id", "session"], F.col("n"), ["n"], rows_per_block=2)
    assert [r.mention for r in got.orderBy("n").collect()] == [None, "Ann", "Ann", None, "Bea", "Bea"]


def test_mention_of_a_result_is_that_of_its_last_row(spark):
    data = [(1, "Tom", "x"), (3, "Ann", "y"), (4, None, "z"), (2, "Bea", "w")]
    df = spark.createDataFrame(data, "n int, first_name string, other string")
    assert conv.mention_of_result(df, ["n"]).first()[0] == "Ann"
    assert conv.mention_of_result(df.limit(0), ["n"]).first()[0] is None
    assert conv.mention_of_result(df.select("n", "other"), ["n"]).first()[0] is None


def test_mentioned_name_takes_first_text_column_with_a_name(spark):
    data = [(1, None, "Tom", "Night"), (2, "x", "Ann", None)]
    df = spark.createDataFrame(data, "name_id int, Nickname string, first_NAME string, other string")
    assert [r[0] for r in df.select(conv.mentioned_name(df)).collect()] == ["Tom", "x"]
    assert df.select("other").select(conv.mentioned_name(df.select("other"))).first()[0] is None

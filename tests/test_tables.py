import pytest
from pyspark.errors import AnalysisException, ParseException

from ringledger.sources import tables


@pytest.fixture(scope="module", autouse=True)
def view(spark):
    spark.createDataFrame([("Ann", 1, None), ("Bea", 2, "x")], "name string, n int, note string").createOrReplaceTempView("people")


def test_select_with_arguments_order_and_comment(spark):
    got = tables.select(spark, "SELECT * FROM people WHERE n >= :least ORDER BY n DESC -- newest first\n;", {"least": 1})
    assert [r.name for r in got.collect()] == ["Bea", "Ann"]


@pytest.mark.parametrize(
    "text", ["DROP VIEW people", "CREATE TABLE t (a INT) USING parquet", "SELECT 1; SELECT 2", "SET x = 1", "SELECT 1) x; DROP VIEW people; --"]
)
def test_only_one_select_runs(spark, text):
    with pytest.raises(ParseException):
        tables.select(spark, text)
    assert spark.table("people").count() == 2


def test_quoted_names_are_columns(spark):
    got = tables.select(spark, """SELECT "name" || '!' AS shout FROM people WHERE "n" = '1' AND name ILIKE 'a%'""")
    assert got.collect() == [("Ann!",)]


def test_settings_are_verified(spark):
    spark.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", "false")
    try:
        with pytest.raises(ValueError, match="doubleQuotedIdentifiers"):
            tables.select(spark, 'SELECT "name" FROM people')
    finally:
        spark.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", "true")


@pytest.mark.parametrize(
    "text",
    [
        "SELECT reflect('java.lang.System', 'getProperty', 'user.name') AS x",
        "SELECT n FROM people WHERE name = java_method('java.lang.System', 'getProperty', 'user.name')",
        "SELECT * FROM csv.`/etc/passwd`",
        "SELECT * FROM stored_elsewhere",
        "SELECT (SELECT max(a) FROM stored_elsewhere) AS x FROM people",
    ],
)
def test_questions_are_confined_to_views(spark, text):
    spark.sql("CREATE TABLE IF NOT EXISTS stored_elsewhere (a INT) USING parquet")
    try:
        with pytest.raises((PermissionError, AnalysisException)):
            tables.select(spark, text)
    finally:
        spark.sql("DROP TABLE stored_elsewhere")


WIDE = ", ".join(f"n + {i} AS c{i}" for i in range(40))
CALL = "('java.lang.System', 'getProperty', 'user.name')"
MANY = ", ".join(f"'{i}'" for i in range(40))


@pytest.mark.parametrize(
    "text",
    [
        f"SELECT {WIDE}, reflect{CALL} AS x FROM people",
        f"SELECT {WIDE}, try_reflect{CALL} AS x FROM people",
        f"SELECT {WIDE}, (SELECT java_method{CALL} FROM people LIMIT 1) AS x FROM people",
        f"SELECT concat({MANY}, reflect{CALL}) AS x FROM people",
        f"WITH w AS (SELECT {WIDE}, reflect{CALL} AS x FROM people) SELECT c1 FROM w WHERE EXISTS (SELECT 1 FROM w WHERE x > '')",
    ],
)
def test_calls_of_the_machine_are_refused_in_wide_questions(spark, text):
    with pytest.raises(PermissionError, match="reflect|java_method"):
        tables.select(spark, text)


def test_catalog_tables_are_refused_in_wide_questions(spark):
    spark.sql("CREATE TABLE IF NOT EXISTS stored_aside (a INT) USING parquet")
    try:
        with pytest.raises(PermissionError, match="stored_aside"):
            tables.select(spark, f"SELECT {WIDE}, (SELECT max(a) FROM stored_aside) AS x FROM people")
    finally:
        spark.sql("DROP TABLE stored_aside")


def test_wide_questions_and_names_of_calls_in_texts_are_answered(spark):
    got = tables.select(spark, f"SELECT {WIDE}, 'reflect(x)' AS x FROM people WHERE n = 1").first()
    assert got.c39 == 40 and got.x == "reflect(x)"


def test_only_the_given_views(spark):
    spark.range(3).createOrReplaceTempView("others")
    assert tables.select(spark, "SELECT * FROM people", views=["people"]).count() == 2
    with pytest.raises(PermissionError, match="others"):
        tables.select(spark, "SELECT * FROM people JOIN others ON n = id", views=["people"])


def test_follow_up_reads_the_last_result_of_the_user(spark, tmp_path):
    one, two = str(tmp_path / "1"), str(tmp_path / "2")
    tables.answer(spark, "SELECT * FROM people WHERE n = 2", one)
    tables.answer(spark, "SELECT * FROM people WHERE n = 1", two)
    follow = "SELECT name FROM last_query_result"
    assert [r.name for r in tables.answer(spark, follow, one).collect()] == ["Bea"]
    assert [r.name for r in tables.answer(spark, follow, two).collect()] == ["Ann"]
    assert tables.answer(spark, "SELECT * FROM people WHERE n = 9", two).collect() == []
    assert [r.name for r in tables.answer(spark, follow, two).collect()] == ["Ann"]


def test_columns_of_one_name_are_stored(spark, tmp_path):
    got = tables.answer(spark, "SELECT n, n, NULL AS nothing FROM people WHERE n = 1", str(tmp_path))
    assert got.collect() == [(1, 1, None)] and got.columns == ["n", "n_2", "nothing"]


def test_records_keep_nulls_and_an_empty_result_says_so(spark):
    full = tables.records_or_message(tables.select(spark, "SELECT * FROM people WHERE n = 1"))
    assert [r.record for r in full.collect()] == ['{"name":"Ann","n":1,"note":null}']
    empty = tables.records_or_message(tables.select(spark, "SELECT * FROM people WHERE n = 5"))
    assert [r.record for r in empty.collect()] == ["No results found."]


@pytest.mark.parametrize(
    "text",
    [
        "SELECT a.name FROM people a, people b",
        "SELECT a.name FROM people a CROSS JOIN people b",
        "SELECT a.name FROM people a JOIN people b ON a.n < b.n",
        "SELECT a.name FROM people a LEFT JOIN people b ON a.n = 1",
        "SELECT name FROM people WHERE n IN (SELECT a.n FROM people a, people b WHERE a.n + b.n = 3 OR a.name > b.name)",
    ],
)
def test_products_are_refused_before_they_run(spark, text):
    with pytest.raises(PermissionError, match="without an equality"):
        tables.select(spark, text)


def test_joins_with_an_equality_and_single_rows_are_answered(spark):
    joined = "SELECT a.name FROM people a JOIN people b ON a.n = b.n + 1 AND a.name > b.name"
    assert tables.select(spark, joined).collect() == [("Bea",)]
    top = "SELECT name FROM people, (SELECT max(n) AS most FROM people) WHERE n = most OR n > most"
    assert tables.select(spark, top).collect() == [("Bea",)]
    assert tables.select(spark, "SELECT name FROM people WHERE n = (SELECT min(n) FROM people)").collect() == [("Ann",)]


def test_a_scan_over_the_bound_is_refused(spark, tmp_path):
    spark.range(100_000).write.parquet(str(tmp_path / "many"))
    tables.register_views(spark, str(tmp_path), ["many"])
    with pytest.raises(PermissionError, match="may read 1000 bytes"):
        tables.select(spark, "SELECT sum(id) AS s FROM many", most_bytes=1_000)
    assert tables.select(spark, "SELECT sum(id) AS s FROM many", most_bytes=10_000_000).collect() == [(4999950000,)]

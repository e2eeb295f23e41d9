import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringledger.functions import decode, text
from ringledger.schemas import FIGHTERS
from ringledger.sources import files
from ringledger.schemas import EVENTS


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize("given, expected", [("33 of 56", (33, 56)), ("0 of 0", (0, 0)), ("---", None), ("", None), (None, None)])
def test_landed_attempted(spark, given, expected):
    got = one(spark, given, decode.landed_attempted)
    assert (tuple(got) if got else None) == expected


@pytest.mark.parametrize(
    "function, given, expected",
    [
        (decode.percent, "58%", 58),
        (decode.percent, "", None),
        (decode.percent, "58", None),
        (decode.clock_seconds, "5:11", 311),
        (decode.clock_seconds, "0:30", 30),
        (decode.clock_seconds, "5:71", None),
        (decode.clock_seconds, "--", None),
        (decode.height_inches, "6' 3\"", 75),
        (decode.height_inches, "5' 11", 71),
        (decode.height_inches, "--", None),
        (decode.weight_pounds, "205 lbs.", 205),
        (decode.weight_pounds, "205", None),
        (decode.drop_one_mark, "6' 3\"", "6' 3"),
        (decode.drop_one_mark, '6""', '6"'),
        (decode.drop_one_mark, "6", "6"),
        (decode.drop_marks, '75""', "75"),
        (decode.drop_marks, "--", None),
        (decode.drop_marks, "", None),
        (decode.drop_marks, '"', None),
        (decode.event_date, "March 11, 1994", dt.date(1994, 3, 11)),
        (decode.event_date, "soon", None),
        (text.title_case, "KO of the Night", "Ko Of The Night"),
        (text.title_case, "sub_of_the_night", "Sub Of The Night"),
        (text.title_case, "4-not o'neil", "4-Not O'Neil"),
        (text.strip_fences, "```sql\nSELECT 1\n```", "SELECT 1"),
        (text.strip_fences, "```SELECT 1``` ", "SELECT 1"),
        (text.strip_fences, " SELECT 1 ", "SELECT 1"),
    ],
)
def test_scalar(spark, function, given, expected):
    assert one(spark, given, function) == expected


@pytest.mark.parametrize(
    "line, expected", [("2025-05-20T10:00:00,Night, part two,2025-05-17", "Night"), ("only", None), ("a,b", "b")]
)
def test_field_of_line(spark, line, expected):
    """A name with a comma is cut, which is why sent events are kept in a table."""
    assert one(spark, line, lambda c: text.field_of_line(c, 1)) == expected


def test_preview_is_cut_after_hundred_characters(spark):
    long = "ä" * 150
    assert one(spark, long, lambda c: text.preview(F.lit("user"), c)) == "- user: " + "ä" * 100 + "..."


def test_missing_tokens_only_as_whole_cells(spark):
    df = spark.createDataFrame([("---", "--", "a--", 1), (None, "", "---x", 2)], "a string, b string, c string, n int")
    assert decode.missing_to_null(df).collect() == [(None, None, "a--", 1), (None, "", "---x", 2)]
    assert decode.missing_to_null(df, ["---"]).collect()[0] == (None, "--", "a--", 1)


def test_typed_keeps_rows_whose_cells_do_not_fit(spark):
    names = FIGHTERS.names
    raw = dict.fromkeys(names, "") | {
        "first_name": "Ann",
        "reach": "75.0",
        "wins": "21",
        "losses": "2.0",
        "draws": "none",
        "last_run": "2025-05-24T12:43:40.46921Z",
    }
    df = spark.createDataFrame([tuple(raw[n] for n in names)], ", ".join(f"{n} string" for n in names))
    row = decode.typed(df, FIGHTERS).first()
    assert (row.first_name, row.reach, row.wins, row.losses, row.draws, row.belt) == ("Ann", 75.0, 21, None, None, None)
    assert row.last_run == dt.datetime(2025, 5, 24, 12, 43, 40, 469210)


def test_only_text_like_a_whole_number_is_cast(spark):
    """A cast that fails costs an exception, so text such as '3 of 4' is not given to it; the values are those of the cast."""
    given = ["7", " 7 ", "+7", "-7", "\t7\n", "007", "7\x7f", "2147483648", "7.0", ".7", "3 of 4", "--", "-", "7 7", "\xa07", "", None]
    raw = spark.createDataFrame([(i, g) for i, g in enumerate(given)], "i int, x string")
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("x", T.IntegerType())])
    df = decode.typed(raw, schema)
    assert [r.x for r in df.orderBy("i").collect()] == [7, 7, 7, -7, 7, 7, 7] + [None] * 10
    assert df._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") == 1


@pytest.mark.parametrize("fraction", [".123456", ".12345", ""])
def test_csv_scan(spark, tmp_path, fraction):
    path = tmp_path / "events.csv"
    path.write_text(
        "event_name,date,location,link,last_updated\n"
        f'"Night ""One"", a",\"March 11, 1994\",,http://x,2025-05-24T12:43:40{fraction}Z\n'
        "Other,unknown,Here,,\n"
    )
    got = files.read_csv(spark, str(path), EVENTS, long_dates=True).collect()
    micro = int((fraction[1:] or "0").ljust(6, "0"))
    assert got == [
        ('Night "One", a', dt.date(1994, 3, 11), None, "http://x", dt.datetime(2025, 5, 24, 12, 43, 40, micro)),
        ("Other", None, "Here", None, None),
    ]


def test_csv_round_trip_makes_empty_text_null(spark, tmp_path):
    df = spark.createDataFrame([("a", "", None), ("b", 'x"y', "z")], "k string, e string, n string")
    files.write_csv(df, str(tmp_path / "t"))
    assert sorted(files.read_csv(spark, str(tmp_path / "t"), df.schema).collect()) == [("a", None, None), ("b", 'x"y', "z")]


def test_blanks_are_those_of_unicode(spark):
    blank = "".join(c for c in map(chr, range(0x3100)) if c.isspace())
    others = "".join(c for c in map(chr, range(1, 0x3100)) if not c.isspace())
    assert one(spark, blank, text.trimmed) == ""
    assert one(spark, blank + others + blank, text.trimmed) == others


def test_csv_rows_that_do_not_fit_are_listed(spark, tmp_path):
    lines = ["a,n", "x,1", "short", "long,2,more", "y,text", '"two\nlines",3']
    (tmp_path / "t.csv").write_text("\n".join(lines) + "\n")
    schema = T.StructType.fromDDL("a string, n int")
    kept = files.read_csv(spark, str(tmp_path), schema, line_breaks=True)
    got = sorted(((r.a, r.n) for r in kept.collect()), key=repr)
    assert got == [("long", 2), ("short", None), ("two\nlines", 3), ("x", 1), ("y", None)]
    bad = files.csv_rejects(spark, str(tmp_path), schema, line_breaks=True)
    assert sorted(r.row.strip() for r in bad.collect()) == ["long,2,more", "short", "y,text"]

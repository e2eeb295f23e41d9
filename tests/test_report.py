import datetime as dt

import pytest
from pyspark.sql import functions as F

from ringledger.operators import joins, latest, records, report
from ringledger.plans.report import deliveries, latest_event, latest_report, outbox, stored_outbox, subscribers
from ringledger.schemas import EVENTS, FIGHTERS, FIGHTS
from tests.conftest import rows

DAY = dt.date(2025, 5, 17)


def fight(event, number, result, one, two, weight="Welterweight", **more):
    base = dict(method="KO/TKO", description="Punches", round=1, time="3:39", championship_fight=0)
    base |= dict(fight_of_the_night=0, performance_of_the_night=0, sub_of_the_night=0, ko_of_the_night=0)
    base |= dict(fight_stats_link=None, last_run=None) | more
    row = dict(event_name=event, fight_id=number, fight_result=result, fighter_1=one, fighter_2=two, weight_class=weight)
    return tuple((row | base)[c] for c in FIGHTS.names)


@pytest.fixture(scope="module")
def events(spark):
    data = [
        ("Later by name", DAY, "Y", None, None),
        ("Burns, Morales", DAY, "Las Vegas, USA", None, None),
        ("Undated", None, "X", None, None),
        ("Older", dt.date(2025, 5, 10), "Z", None, None),
    ]
    return spark.createDataFrame(data, EVENTS)


@pytest.fixture(scope="module")
def fights(spark):
    e = "Burns, Morales"
    data = [
        fight(e, 1, "Michael M", "Michael M", "Gilbert B", performance_of_the_night=1, ko_of_the_night=1),
        fight(e, 2, "nc", "Mairon S", "Sodiq Y", method="U-DEC", description=None, round=3, time="5:00"),
        fight(e, 3, "Nursulton R", "Dustin S", "Nursulton R", "Open Weight", championship_fight=1, description=""),
        fight(e, 10, "Ann A", "Ann A", "Bea B", championship_fight=1, sub_of_the_night=1),
        fight("Older", 1, "Bea B", "Ann A", "Bea B", championship_fight=1, performance_of_the_night=1),
    ]
    return spark.createDataFrame(data, FIGHTS)


def test_latest_event_has_a_date(events):
    assert latest_event(events).collect() == [("Burns, Morales", "Las Vegas, USA", DAY)]


CARD = [
    "Welterweight - Winner: <b>Ann A</b> | Loser: Bea B | KO/TKO (Punches) R1 @ 3:39 - Welterweight Championship Fight",
    "Open Weight - Winner: <b>Nursulton R</b> | Loser: Dustin S | KO/TKO R1 @ 3:39 - UFC Championship",
    "Welterweight - Winner: <b>None</b> | Loser: None | U-DEC R3 @ 5:00",
    "Welterweight - Winner: <b>Michael M</b> | Loser: Gilbert B | KO/TKO (Punches) R1 @ 3:39",
]


def test_report(events, fights):
    got = rows(latest_report(events, fights).select("kind", "text"))
    assert got == [
        (1, "<b>🏟️ Last UFC Event:</b>\nEvent: Burns, Morales\nLocation: Las Vegas, USA\nDate: 2025-05-17"),
        (2, "<b>🥊 Fight Card Results:</b>\n" + "\n\n".join(CARD)),
        (
            3,
            "<b>🏆 Event Highlights:</b>\nPerformance Of The Night: Michael M vs Gilbert B\n"
            "Ko Of The Night: Michael M vs Gilbert B\nSubmission Of The Night: Ann A vs Bea B",
        ),
    ]


def test_report_without_fights_has_head_and_empty_card(events, fights):
    got = rows(latest_report(events, fights.limit(0)).select("kind", "text"))
    assert [k for k, _ in got] == [1, 2] and got[1][1] == "<b>🥊 Fight Card Results:</b>\n"


def test_long_card_is_one_text(spark, events):
    """Numbers far apart and thousands of lines: one text per event, awards by kind over the whole card."""
    number = F.col("id") * 1_000 + 1
    base = {c.name: F.lit(None).cast(c.dataType) for c in FIGHTS.fields}
    base |= {"event_name": F.lit("Burns, Morales"), "fight_id": number.cast("int"), "fighter_1": F.concat(F.lit("A"), "id")}
    base |= {"fighter_2": F.lit("B"), "method": F.lit("KO"), "round": F.lit(1), "time": F.lit("1:00"), "weight_class": F.lit("W")}
    base |= {flag: (F.col("id") % 2 == k % 2).cast("int") for k, (flag, _) in enumerate(report.AWARDS)}
    long = spark.range(3_000).select(*[base[c].alias(c) for c in FIGHTS.names])
    got = {r.kind: r.text for r in latest_report(events, long).collect()}
    assert sorted(got) == [1, 2, 3] and got[2].count("\n\n") == 2_999
    kinds = [line.split(" Of ")[0] for line in got[3].split("\n")[1:]]
    assert kinds == ["Performance"] * 1_500 + ["Ko"] * 1_500 + ["Submission"] * 1_500
    lines = report.card_lines(long)
    texts = report.joined_lines(lines, ["event_name"], "line", "\n\n", "fight_id DESC", "text").collect()
    assert len(texts) == 1 and texts[0].text == got[2].split("\n", 1)[1]


def test_texts_are_stored_once(spark, events, fights, tmp_path):
    users = spark.range(50).select(F.col("id").cast("string").alias("user_id"))
    box = stored_outbox(spark, users, latest_report(events, fights), str(tmp_path / "m"))
    assert box.columns == ["user_id", "event_name", "kind"] and box.count() == 150
    sent = deliveries(box, spark.read.parquet(str(tmp_path / "m")))
    assert sent.count() == 150 and sent.filter("text IS NULL").count() == 0


def test_literal_winner_rule_is_wrong(fights):
    """Comparing the result with the text 'fighter_1' makes the second fighter win each time."""
    literal = F.when(F.col("fight_result") == "fighter_1", F.col("fighter_1")).otherwise(F.col("fighter_2"))
    right = report.winner(F.col("fight_result"), F.col("fighter_1"), F.col("fighter_2"))
    wrong = fights.filter(~literal.eqNullSafe(right)).count()
    assert wrong == 3


def test_both_forms_of_the_awards_agree(fights):
    tags = [(F.col(flag) == 1, text) for flag, text in report.AWARDS]
    union = report.tagged_by_union(fights, tags, report.matchup(F.col("fighter_1"), F.col("fighter_2")))
    assert rows(union) == rows(report.awards(fights).select("type", "matchup"))


def test_awards_read_the_table_once(spark, fights, tmp_path):
    fights.write.parquet(str(tmp_path / "f"))
    plan = report.awards(spark.read.parquet(str(tmp_path / "f")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


ACTIONS = [
    ("1", "a", "subscribe", "2025-05-01T10:00:00.5", 1),
    ("1", "a", "unsubscribe", "2025-05-02T10:00:00", 0),
    ("1", "a", "subscribe", "2025-05-02T10:00:00.000001", 1),
    ("2", "b", "subscribe", "2025-05-01T10:00:00", 1),
    ("2", "b", "unsubscribe", "2025-05-03T10:00:00", 0),
    ("3", "", "unsubscribe", "2025-05-01T10:00:00", 0),
    (None, None, None, None, None),
]


def test_subscribers(spark):
    schema = "user_id string, username string, action string, timestamp string, subscribe int"
    df = spark.createDataFrame(ACTIONS, schema)
    assert rows(latest.ever_subscribed(df, "user_id", "action")) == [("1",), ("2",)]
    assert rows(subscribers(df)) == [("1",)]
    assert rows(subscribers(df.unionAll(df))) == [("1",)]


def test_outbox_gives_each_user_each_message(spark, events, fights):
    users = spark.createDataFrame([("1",), ("2",)], "user_id string")
    box = outbox(users, latest_report(events, fights))
    assert rows(box.select("user_id", "kind")) == [(u, k) for u in ("1", "2") for k in (1, 2, 3)]
    plan = box._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_records_and_last_fight(events, fights):
    sides = records.two_sides(fights, "fighter_1", "fighter_2", "fight_result", ["event_name", "fight_id"])
    got = {r.fighter: (r.wins, r.losses, r.no_contests) for r in records.record(sides).collect()}
    assert got["Ann A"] == (1, 1, 0) and got["Bea B"] == (1, 1, 0)
    assert got["Nursulton R"] == (1, 0, 0) and got["Dustin S"] == (0, 1, 0) and got["Mairon S"] == (0, 0, 1)
    last = {r.fighter: (r.event_name, r.fight_id, r.outcome) for r in records.last_fight(sides, events).collect()}
    assert last["Bea B"] == ("Burns, Morales", 10, "loss")


def test_champions(spark, fights):
    def fighter(first, last, belt):
        return tuple({"first_name": first, "last_name": last, "belt": belt}.get(n) for n in FIGHTERS.names)

    people = [fighter("Ann", "A", "Yes"), fighter("Bea", "B", None), fighter("Eve", "E", "Yes")]
    people = spark.createDataFrame(people, FIGHTERS)
    title = fights.filter("championship_fight = 1").withColumn("n", F.when(F.col("event_name") == "Older", 0).otherwise(1))
    sides = records.two_sides(title, "fighter_1", "fighter_2", "fight_result", ["weight_class", "n", "fight_id"])
    assert rows(joins.champions(people, sides, ["n", "fight_id"])) == [("Ann A", "Welterweight"), ("Eve E", None)]


def test_closest_name(spark):
    names = spark.createDataFrame([("Jon Jones",), ("Joe Jonas",), ("Jon Jonas",), (None,)], "name string")
    got = {r.asked: (r.closest, r.distance) for r in joins.closest_names(names, "name", ["jon jones", "Jo Jonas"]).collect()}
    assert got == {"jon jones": ("Jon Jones", 2), "Jo Jonas": ("Joe Jonas", 1)}


def test_left_join_null_keys(spark):
    a = spark.createDataFrame([("x", None, 1), ("y", "k", 2), ("z", "k", 3)], "e string, f string, a int")
    b = spark.createDataFrame([("x", None, 9), ("y", "k", 8)], "e string, f string, b int")
    assert rows(joins.left_join(a, b, ["e", "f"])) == [("x", None, 1, None), ("y", "k", 2, 8), ("z", "k", 3, None)]
    assert rows(joins.left_join(a, b, ["e", "f"], True)) == [("x", None, 1, 9), ("y", "k", 2, 8), ("z", "k", 3, None)]


def test_pairs_and_roll_up(spark):
    data = [("e", 1, "a", "5 of 18"), ("e", 1, "b", "33 of 56"), ("e", 2, "a", "0 of 0"), ("e", 3, "a", "---")]
    df = spark.createDataFrame(data, "event string, fight_id int, fighter string, total_strikes string")
    assert rows(records.pair_violations(df, ["event", "fight_id"])) == [("e", 2, 1), ("e", 3, 1)]
    assert rows(records.roll_up(df, ["fighter"], ["total_strikes"])) == [("a", 5, 18, 0.2778), ("b", 33, 56, 0.5893)]
    by_fight = rows(records.roll_up(df, ["event", "fight_id"], ["total_strikes"]))
    assert by_fight == [("e", 1, 38, 74, 0.5135), ("e", 2, 0, 0, None), ("e", 3, None, None, None)]

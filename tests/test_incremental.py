import pytest
from pyspark.sql import functions as F

from ringledger.operators import incremental as inc

NAMES = ["e1", "e2", "e3", "e2", "e5"]


@pytest.fixture(scope="module")
def listing(spark):
    return spark.createDataFrame(list(enumerate(NAMES, 1)), "position int, name string")


def places(df):
    return sorted(r.position for r in df.collect())


ALL = [1, 2, 3, 4, 5]


@pytest.mark.parametrize(
    "mark, expected", [("e1", [2, 3, 4, 5]), ("e2", [3, 4, 5]), ("e5", []), ("gone", ALL), (None, ALL), ("", ALL)]
)
def test_since_bookmark(listing, mark, expected):
    assert places(inc.since_bookmark(listing, "name", "position", mark)) == expected


# upstream, done, rule of the fights job, rule of the statistics job
GAPS = [
    ("e5", "e1", [2, 3, 4, 5], [2, 3, 4, 5]),
    ("e3", "e1", [2, 3], [2, 3]),
    ("e2", "e1", [2], [2]),
    ("e1", "e3", [], []),
    ("e3", "e3", [], []),
    ("e3", None, [1, 2, 3], [1, 2, 3]),
    ("e3", "gone", [1, 2, 3], []),
    ("gone", "e3", [], [4, 5]),
    ("gone", None, ALL, ALL),
    ("gone", "lost", ALL, ALL),
    (None, "e3", ALL, [4, 5]),
    (None, None, ALL, ALL),
    (None, "gone", ALL, ALL),
    ("", "e3", ALL, [4, 5]),
    ("e3", "", [1, 2, 3], [1, 2, 3]),
]


@pytest.mark.parametrize("upstream, done, fights, stats", GAPS)
def test_gap(listing, upstream, done, fights, stats):
    assert places(inc.gap_after_done(listing, "name", "position", upstream, done)) == fights
    assert places(inc.gap_up_to_known(listing, "name", "position", upstream, done)) == stats


@pytest.mark.parametrize("upstream, done, fights, stats", GAPS[:8])
def test_gap_with_bookmarks_from_tables(spark, listing, upstream, done, fights, stats):
    def mark(value):
        return spark.createDataFrame([(value,)], "m string").agg(F.max("m")).scalar()

    assert places(inc.gap_after_done(listing, "name", "position", mark(upstream), mark(done))) == fights
    assert places(inc.gap_up_to_known(listing, "name", "position", mark(upstream), mark(done))) == stats


def test_gap_of_empty_listing(listing):
    none = listing.limit(0)
    assert places(inc.gap_after_done(none, "name", "position", "e1", None)) == []
    assert places(inc.gap_up_to_known(none, "name", "position", "e1", None)) == []


def test_listing_is_neither_sorted_nor_shuffled(listing):
    plan = inc.gap_after_done(listing, "name", "position", "e5", "e1")._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Subquery")[0]
    assert "Exchange" not in main and "Sort" not in main and "Window" not in main


def test_not_yet_stored_matches_null_keys_and_keeps_doubles(spark):
    new = spark.createDataFrame([("a", None, 1), ("b", "x", 2), ("b", "x", 3), ("c", None, 4)], "n string, l string, i int")
    stored = spark.createDataFrame([("a", None), ("c", "y")], "n string, l string")
    got = inc.not_yet_stored(new, stored, ["n", "l"])
    assert sorted(r.i for r in got.collect()) == [2, 3, 4]


def test_history_is_reduced_to_the_new_keys_first(spark):
    new = spark.createDataFrame([("a", 1)], "n string, i int")
    plan = inc.not_yet_stored(new, spark.range(9).selectExpr("string(id) n"), ["n"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftAnti") < plan.index("LeftSemi")


def test_unsent_event_with_comma_in_name(spark):
    events = spark.createDataFrame([("Night, part two",), ("Other",)], "event_name string")
    sent = spark.createDataFrame([("Night, part two",)], "event_name string")
    assert inc.unsent(events, sent, "event_name").collect() == [("Other",)]

"""The weekly load on a made-up site: three runs, a repeated run, broken pages and a failing step."""

import pytest
from pyspark.sql import functions as F

from ringledger.plans import weekly
from ringledger.plans.weekly import Folders, Job
from ringledger.sources import files, manifest, versions
from ringledger.schemas import PAGES, PAIR_STATS, WAREHOUSE
from ringledger.operators import records
from ringledger.streaming import actions
from tests import site
from tests.conftest import rows
from tests.test_extract import good_page, stats

LINKS = {n: f"http://site.test/e{n}" for n in range(1, 5)}
EVENTS = [(f"Night {n}, part", f"May {n + 9}, 2025", f"City {n}" if n > 1 else "---", LINKS[n]) for n in range(1, 5)]


def fights_of(n):
    return [
        ("win", "Ann A", "Bea B", "Lightweight", "KO/TKO", "Punches", "1", "3:39", ["belt.png", "perf.png"], f"http://d/{n}-1"),
        ("nc", "Cid C", "Dan D", "Open Weight", "---", "--", "3", "5:00", [], f"http://d/{n}-2"),
    ]


def pages_frame(spark, upto, broken=()):
    """Pages after `upto` events; the statistics page of each second fight is one that cannot be read."""
    out = [(site.INDEX, "<html>old fetch</html>"), (site.INDEX, site.index_page(list(reversed(EVENTS[:upto]))))]
    for n in range(1, upto + 1):
        out.append((LINKS[n], site.event_page(fights_of(n))))
        out.append((f"http://d/{n}-1", good_page()))
        out.append((f"http://d/{n}-2", "<html>no sections</html>"))
    people = [("Ann", "A", "--", "6' 1\"", "155 lbs.", '70"', "Orthodox", "9", "1", "0", True, "http://f/1")]
    out.append(("http://site.test/fighters?char=a&page=all", site.directory_page(people)))
    out.append(("http://site.test/fighters?char=b&page=all", "<html>none</html>"))
    data = [(i, u, h) for i, (u, h) in enumerate(out) if u not in broken]
    return spark.createDataFrame(data, PAGES)


@pytest.fixture()
def make(spark, tmp_path):
    folders = Folders(str(tmp_path))
    actions = [("1", "a", "subscribe", "2025-05-01T00:00:00", 1), ("2", "b", "unsubscribe", "2025-05-01T00:00:00", 0)]
    schema = "user_id string, username string, action string, timestamp string, subscribe int"
    spark.createDataFrame(actions, schema).write.parquet(folders.at("user_actions"))

    def job(run, pages):
        index = F.col("url") == site.INDEX
        return Job(spark, folders, pages, run, index, F.col("url").startswith("http://site.test/fighters?char="))

    return job


def warehouse(job, table):
    return versions.read_current(job.spark, f"{job.folders.at('warehouse')}/{table}")


def test_three_runs_and_a_repeat(spark, make):
    first = make("r1", pages_frame(spark, 2))
    counts = weekly.run_weekly(first)
    assert counts == {"events": 2, "fighters": 1, "fights": 4, "stats": 4, "warehouse": 5, "notify": 1}

    events = rows(warehouse(first, "events").select("event_name", F.col("date").cast("string"), "location"))
    assert events == [("Night 1, part", "2025-05-10", None), ("Night 2, part", "2025-05-11", "City 2")]
    fights = warehouse(first, "fights")
    assert rows(fights.select("fight_id", "fight_result", "method", "description", "round").distinct()) == [
        (1, "Ann A", "KO/TKO", "Punches", 1),
        (2, "nc", None, "--", 3),
    ]
    fighters = warehouse(first, "fighters").select("first_name", "nickname", "height", "reach", "wins", "belt")
    assert rows(fighters) == [("Ann", None, "6' 1", 70.0, 9, "Yes")]
    totals = warehouse(first, "fight_stats")
    assert rows(totals.select("event", "fight_id", "fighter", "significant_strikes", "ground_strikes")) == [
        (f"Night {n}, part", 1, f, f"t{f}1", f"s{f}5") for n in (1, 2) for f in ("Ann A", "Bea B")
    ]
    rounds = warehouse(first, "round_stats")
    assert rounds.count() == 8 and records.pair_violations(rounds, ["event", "fight_id", "round"]).isEmpty()
    state = files.read_state(spark, first.folders.at("state")).first()
    assert state.last_event == "Night 2, part"
    stamps = {r[0] for r in fights.select("last_run").distinct().collect()}
    assert len(stamps) == 1 and {r[0] for r in totals.select("last_run").distinct().collect()} == stamps

    # nothing new: tables stay, the audit goes on, no second notification
    again = make("r2", pages_frame(spark, 2))
    assert weekly.run_weekly(again) == {"events": 0, "fighters": 1, "fights": 0, "stats": 0, "warehouse": 5, "notify": 0}
    assert warehouse(again, "fights").count() == 4

    # two new events, then the same run once more
    third = make("r3", pages_frame(spark, 4))
    expected = {"events": 2, "fighters": 1, "fights": 4, "stats": 4, "warehouse": 5, "notify": 1}
    assert weekly.run_weekly(third) == expected
    before = {t: rows(warehouse(third, t).drop("last_run", "last_updated")) for t in ("events", "fights", "fight_stats", "round_stats")}
    assert weekly.run_weekly(third) == expected | {"notify": 0}
    # a run from before is repeated late: its slice stays whole and nothing is doubled
    assert weekly.load_events(first) == 2 and weekly.load_fights(first) == 4 and weekly.load_stats(first) == 4
    weekly.load_warehouse(third)
    after = {t: rows(warehouse(third, t).drop("last_run", "last_updated")) for t in before}
    assert after == before and {t: len(v) for t, v in after.items()} == {"events": 4, "fights": 8, "fight_stats": 8, "round_stats": 16}

    loaded = {}
    weekly.load_warehouse(third, write=lambda df, name: loaded.update({name: df.schema.names}))
    assert loaded == {name: schema.names for name, schema in WAREHOUSE.items()}

    sent = spark.read.parquet(third.folders.at("notifications"))
    assert rows(sent.select("event_name")) == [("Night 2, part",), ("Night 4, part",)]
    box = spark.read.parquet(third.folders.at("outbox"))
    assert rows(box.select("user_id", "event_name", "kind")) == [
        ("1", f"Night {n}, part", k) for n in (2, 4) for k in (1, 2, 3)
    ]
    rejects = spark.read.parquet(third.folders.at("rejects")).filter("job = 'stats'")
    assert rows(rejects.select("key", "reason").distinct()) == [(f"Night {n}, part#2", "page not readable") for n in range(1, 5)]
    audit = spark.read.parquet(third.folders.at("run_audit"))
    assert audit.filter("job = 'events' AND new_rows = 0").count() == 1


def test_missing_pages_are_rejected_and_the_rest_goes_on(spark, make):
    job = make("r1", pages_frame(spark, 2, broken=("http://d/1-1", LINKS[2])))
    counts = weekly.run_weekly(job)
    assert (counts["events"], counts["fights"], counts["stats"]) == (2, 2, 0)
    rejects = spark.read.parquet(job.folders.at("rejects")).filter("job = 'stats'")
    no_event = spark.read.parquet(job.folders.at("rejects")).filter("job = 'fights'")
    assert rows(no_event.select("key", "reason")) == [("Night 2, part", "no page")]
    assert rows(rejects.select("key", "reason")) == [("Night 1, part#1", "no page"), ("Night 1, part#2", "page not readable")]


def test_run_without_directory_pages_keeps_the_fighters(spark, make):
    first = make("r1", pages_frame(spark, 1))
    weekly.run_weekly(first)
    lost = pages_frame(spark, 2, broken=[f"http://site.test/fighters?char={c}&page=all" for c in "ab"])
    second = make("r2", lost)
    counts = weekly.run_weekly(second)
    assert counts["fighters"] == 0 and counts["events"] == 1
    assert rows(warehouse(second, "fighters").select("first_name")) == [("Ann",)]
    rejects = spark.read.parquet(second.folders.at("rejects")).filter("job = 'fighters'")
    assert rows(rejects.select("reason")) == [("no readable directory page",)]


def test_markup_moves_once_and_bookmarks_read_one_slice(spark, make):
    job = make("r1", pages_frame(spark, 2))
    weekly.run_weekly(job)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = job.pages.select("page_id", "url", "html")
        path = job.folders.at("pages")
        stored.write.parquet(path)
        pages = spark.read.parquet(path)
        wanted = spark.createDataFrame([("Night 1", 1, LINKS[1])], "event_name string, event_position int, url string")
        got = weekly._newest_fetch(pages, ["event_name", "event_position"], wanted)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert sum("html" in scan for scan in plan.split("FileScan")[1:]) == 1
        assert not any("html" in line for line in plan.splitlines() if "Aggregate(" in line)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    mark = job.last(job.up_to_now("fights"), "event_name", "event_position")
    assert "PartitionFilters: [isnotnull(run" in mark._jdf.queryExecution().executedPlan().toString()


def test_streamed_states_name_the_recipients(spark, make):
    job = make("r1", pages_frame(spark, 1))
    log = spark.read.parquet(job.folders.at("user_actions"))
    state = job.folders.at("subscriber_state")
    states = actions.subscriber_states(actions.timed(log), "user_id", "action", ["time", "timestamp"])
    actions.slice_writer(f"{state}/slices")(states, "query=q/batch_id=0")
    weekly.run_weekly(job)
    assert rows(spark.read.parquet(job.folders.at("outbox")).select("user_id").distinct()) == [("1",)]


def test_failing_step_is_audited(spark, make, monkeypatch):
    job = make("r1", pages_frame(spark, 1))
    with pytest.raises(ValueError, match="no run state"):
        job.last_run()
    weekly.load_events(job)
    message = " ".join(f"reason {n}" for n in range(250))

    def broken(job):
        raise RuntimeError(message)

    monkeypatch.setitem(weekly.STEPS, "fighters", broken)
    with pytest.raises(RuntimeError, match="reason 249"):
        weekly.run_weekly(make("r2", pages_frame(spark, 1)))
    failed = spark.read.parquet(job.folders.at("run_audit")).filter("status LIKE 'failed:%'").collect()
    assert [(r.job, r.status) for r in failed] == [("fighters", f"failed: {message}")] and len(message) > 2_000


def test_roll_up_of_round_rows_equals_the_fight_rows(spark):
    data = [("e", 1, f"Round {r}", f, f"{r} of {r + n}") for r in (1, 2, 3) for n, f in enumerate(("a", "b"))]
    df = spark.createDataFrame(data, "event string, fight_id int, round string, fighter string, total_strikes string")
    got = rows(records.roll_up(df, ["event", "fight_id", "fighter"], ["total_strikes"]))
    assert got == [("e", 1, "a", 6, 6, 1.0), ("e", 1, "b", 6, 9, 0.6667)]
    assert "total_strikes" in PAIR_STATS and stats("t", 1)


def test_a_list_of_several_pages(spark, make):
    def job(run, upto, size=2):
        pages = pages_frame(spark, upto).filter(F.col("url") != site.INDEX)
        cut = [(f"{site.INDEX}&part={k}", site.index_page(list(reversed(EVENTS[:upto][k * size : k * size + size])))) for k in range(2)]
        # the page with the newest events has the highest number, whatever the order of the fetches
        listed = spark.createDataFrame([(100 - k, u, h) for k, (u, h) in enumerate(cut) if EVENTS[:upto][k * size :]], PAGES)
        out = make(run, pages.unionByName(listed))
        out.index, out.index_page = F.col("url").startswith(site.INDEX), F.substring_index("url", "=", -1)
        return out

    def places(done):
        return rows(done.up_to_now("events").select("run", "position", "event_name"))

    first = job("r1", 3)
    assert weekly.load_events(first) == 3
    assert places(first) == [("r1", n, EVENTS[n - 1][0]) for n in (1, 2, 3)]
    second = job("r2", 4)
    assert weekly.load_events(second) == 1
    assert places(second)[-1] == ("r2", 4, EVENTS[3][0])
    assert rows(second.staged("links").select("position", "event_name")) == [(n + 1, e[0]) for n, e in enumerate(EVENTS)]


def test_a_list_page_without_rows_is_rejected(spark, make):
    bad = spark.createDataFrame([(100, f"{site.INDEX}&part=1", "<html>busy</html>"), (101, f"{site.INDEX}&part=0", site.index_page(EVENTS[:1]))], PAGES)
    done = make("r1", pages_frame(spark, 1).filter(F.col("url") != site.INDEX).unionByName(bad))
    done.index, done.index_page = F.col("url").startswith(site.INDEX), F.substring_index("url", "=", -1)
    assert weekly.load_events(done) == 1
    rejects = spark.read.parquet(f"{done.folders.at('rejects')}/job=events").select("key", "reason")
    assert (f"{site.INDEX}&part=1", "no rows in list page") in rows(rejects)


def test_the_list_of_the_check_is_in_pages_of_bounded_size(spark):
    from ringledger.checks import load

    folder = "/root/testdata/sf0.01"
    listed = load._index(spark, folder, F.lit(1 << 40))
    sizes = [r.n for r in listed.select((F.size(F.split("html", "<tr ")) - 2).alias("n")).collect()]
    cards = spark.read.parquet(f"{folder}/customer.parquet").select(F.floor(F.col("c_custkey") / 20)).distinct().count()
    assert sum(sizes) == cards and max(sizes) <= 50 < cards

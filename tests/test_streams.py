import json

import pytest
from pyspark.sql import functions as F

from ringledger.plans import report
from ringledger.schemas import ACTION
from ringledger.sources import tables
from ringledger.streaming import actions
from tests.conftest import rows

COLUMNS = {f.name: f.dataType.simpleString() for f in ACTION.fields}


def put(spark, folder, *lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(folder)


def message(user, action, at):
    return json.dumps({"user_id": user, "username": "n", "action": action, "timestamp": at, "subscribe": int(action == "subscribe")})


def test_parse_rules(spark):
    lines = [message(7, "subscribe", "t"), '{"user_id": "8"}', "not json", '{"user_id": "9", "subscribe": "x"}']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert actions.parsed(df).collect()[:3] == [
        ("7", "n", "subscribe", "t", 1),
        ("8", None, None, None, None),
        (None, None, None, None, None),
    ]
    good, bad = actions.split_rejects(df)
    assert [r.user_id for r in good.collect()] == ["7", "8"]
    assert [r.message for r in bad.collect()] == lines[2:]


def test_encoded_message(spark):
    df = spark.createDataFrame([(5, None, True), (6, "x", False)], "u bigint, n string, s boolean")
    got = df.select(actions.encoded(F.col("u"), F.col("n"), F.col("s"), F.lit("t"))).collect()
    assert [json.loads(r[0]) for r in got] == [
        {"user_id": 5, "username": "", "action": "subscribe", "timestamp": "t", "subscribe": 1},
        {"user_id": 6, "username": "x", "action": "unsubscribe", "timestamp": "t", "subscribe": 0},
    ]


def test_restart_takes_only_new_messages(spark, tmp_path):
    base = str(tmp_path)

    def run():
        stream = actions.parsed(actions.file_messages(spark, f"{base}/in"))
        actions.run_once(stream, actions.slice_writer(f"{base}/out"), f"{base}/cp")
        return rows(actions.read_slices(spark, f"{base}/out", COLUMNS).select("user_id", "batch_id"))

    put(spark, f"{base}/in", message("1", "subscribe", "a"))
    assert run() == [("1", 0)]
    put(spark, f"{base}/in", message("2", "subscribe", "b"))
    assert run() == [("1", 0), ("2", 1)]
    assert run() == [("1", 0), ("2", 1)]


def test_batch_that_is_replayed_after_a_failure_is_stored_once(spark, tmp_path):
    base = str(tmp_path)
    put(spark, f"{base}/in", message("1", "subscribe", "a"), message("2", "subscribe", "b"))
    write = actions.slice_writer(f"{base}/out")

    def failing(batch, place):
        write(batch, place)
        raise RuntimeError("lost after the write")

    with pytest.raises(Exception, match="lost after the write"):
        actions.run_once(actions.parsed(actions.file_messages(spark, f"{base}/in")), failing, f"{base}/cp")
    actions.run_once(actions.parsed(actions.file_messages(spark, f"{base}/in")), write, f"{base}/cp")
    assert rows(actions.read_slices(spark, f"{base}/out", COLUMNS).select("user_id")) == [("1",), ("2",)]


def test_rejects_are_kept(spark, tmp_path):
    base = str(tmp_path)
    put(spark, f"{base}/in", message("1", "subscribe", "a"), "broken {")
    write = actions.rejecting_writer(f"{base}/out", f"{base}/bad")
    actions.run_once(actions.file_messages(spark, f"{base}/in"), write, f"{base}/cp")
    assert rows(actions.read_slices(spark, f"{base}/out", COLUMNS).select("user_id")) == [("1",)]
    assert rows(actions.read_slices(spark, f"{base}/bad", {"message": "string"}).select("message")) == [("broken {",)]


def test_new_checkpoint_over_an_old_folder_loses_nothing(spark, tmp_path):
    base = str(tmp_path)
    put(spark, f"{base}/in", message("1", "subscribe", "a"), message("2", "subscribe", "a"))
    actions.run_once(actions.parsed(actions.file_messages(spark, f"{base}/in")), actions.slice_writer(f"{base}/out"), f"{base}/cp")
    put(spark, f"{base}/later", message("3", "subscribe", "b"))
    actions.run_once(actions.parsed(actions.file_messages(spark, f"{base}/later")), actions.slice_writer(f"{base}/out"), f"{base}/cp2")
    got = actions.read_slices(spark, f"{base}/out", COLUMNS)
    assert rows(got.select("user_id", "batch_id")) == [("1", 0), ("2", 0), ("3", 0)]
    assert got.select("query").distinct().count() == 2


def test_console_prints_every_row(spark, capsys):
    actions.console_writer()(spark.range(30).toDF("n"), "batch_id=0")
    assert len(capsys.readouterr().out.splitlines()) == 30


@pytest.mark.parametrize("snapshots", [False, True])
def test_subscriber_state_over_runs(spark, tmp_path, snapshots):
    base = str(tmp_path)
    state = f"{base}/state"

    def run(*lines, checkpoint="cp"):
        put(spark, f"{base}/in", *lines)
        report.keep_subscribers(actions.parsed(actions.file_messages(spark, f"{base}/in")), state, f"{base}/{checkpoint}")
        got = rows(report.streamed_subscribers(spark, state))
        if snapshots:
            actions.take_snapshot(spark, state, "user_id", "action", report.STATE_COLUMNS)
            assert rows(report.streamed_subscribers(spark, state)) == got
        return got

    assert rows(report.streamed_subscribers(spark, state)) == []
    assert run(message("1", "subscribe", "2025-01-02"), message("2", "subscribe", "2025-01-02")) == [("1",), ("2",)]
    # an older action that arrives late does not undo a newer one; times count, not their text
    assert run(message("1", "unsubscribe", "2025-01-01"), message("2", "unsubscribe", "2025-01-02T00:00:00.5")) == [("1",)]
    assert run(message("2", "subscribe", "2025-01-10")) == [("1",), ("2",)]
    # a new checkpoint reads everything again and changes nothing
    assert run(message("1", "unsubscribe", "2025-01-09"), checkpoint="cp2") == [("2",)]


def test_state_reads_the_snapshot_and_later_slices_only(spark, tmp_path):
    base, state = str(tmp_path), f"{tmp_path}/state"
    for day in ("01", "02", "03"):
        put(spark, f"{base}/in", message(day, "subscribe", f"2025-01-{day}"))
        report.keep_subscribers(actions.parsed(actions.file_messages(spark, f"{base}/in")), state, f"{base}/cp")
        if day == "02":
            actions.take_snapshot(spark, state, "user_id", "action", report.STATE_COLUMNS)
    read = actions.current_states(spark, state, "user_id", "action", report.STATE_COLUMNS)
    assert rows(read.select("user_id")) == [("01",), ("02",), ("03",)]
    scanned = {f.split("/state/")[1].rsplit("/", 1)[0] for f in read.select("user_id", "action").inputFiles()}
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(NOT" in plan or "batch_id" in plan
    assert any(s.startswith("snapshots/") for s in scanned)


def test_actions_table_is_created_once(spark, tmp_path):
    place = f"file://{tmp_path}/user_actions"
    tables.create_actions_table(spark, location=place)
    spark.sql("INSERT INTO user_actions VALUES ('1', 'n', 'subscribe', 't', 1)")
    tables.create_actions_table(spark, location=place)
    assert spark.table("user_actions").count() == 1
    spark.sql("DROP TABLE user_actions")


def test_a_batch_is_written_once_and_unfinished_slices_are_not_read(spark, tmp_path):
    out, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")
    df = spark.createDataFrame([("1", "a")], "user_id string, action string")
    written = []

    def write(batch, place):
        written.append(place)
        actions.slice_writer(out)(batch, place)
        if len(written) == 2:
            raise OSError("lost between the rows and the ledger")

    once = actions.ledgered(write, ledger)
    once(df, "query=q/batch_id=0")
    once(df, "query=q/batch_id=0")
    with pytest.raises(OSError):
        once(df, "query=q/batch_id=1")
    columns = {"user_id": "string", "action": "string"}
    assert rows(actions.committed(spark, out, ledger, columns)) == [("1", "a", "q", 0)]
    once(df, "query=q/batch_id=1")
    assert written == ["query=q/batch_id=0", "query=q/batch_id=1", "query=q/batch_id=1"]
    assert rows(actions.committed(spark, out, ledger, columns)) == [("1", "a", "q", 0), ("1", "a", "q", 1)]
    assert actions.committed(spark, out, str(tmp_path / "none"), columns).collect() == []

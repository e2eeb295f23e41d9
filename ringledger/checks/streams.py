"""Streams of JSON actions made from the events table and read from files."""

from pyspark.sql import functions as F

from ringledger.checks.registry import check, table
from ringledger.functions.text import iso_text
from ringledger.plans import report
from ringledger.schemas import ACTION
from ringledger.session import shared_folder
from ringledger.streaming import actions

_COLUMNS = {f.name: f.dataType.simpleString() for f in ACTION.fields}
_MESSAGE = """user_id::VARCHAR AS user_id, 'u' || user_id AS username,
    CASE WHEN event_type = 'signup' THEN 'subscribe' ELSE 'unsubscribe' END AS action,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp, (event_type = 'signup')::INT AS subscribe"""


_EARLY = "ts < TIMESTAMP_NTZ '2024-01-16'"


def _messages(spark, d):
    name = F.concat(F.lit("u"), "user_id")
    value = actions.encoded(
        F.col("user_id").cast("string"), name, F.col("event_type") == "signup", iso_text(F.col("ts"))
    )
    return table(spark, d, "events").select("ts", "event_type", value.alias("value"))


def _publish(messages, folder):
    messages.select("value").write.mode("append").text(folder)


@check(f"SELECT {_MESSAGE} FROM events")
def stream_json_ingest(spark, d):
    base = shared_folder(spark)
    _publish(_messages(spark, d), f"{base}/in")
    rows = actions.parsed(actions.file_messages(spark, f"{base}/in"))
    actions.run_once(rows, actions.slice_writer(f"{base}/out"), f"{base}/checkpoint")
    return actions.read_slices(spark, f"{base}/out", _COLUMNS).drop("query", "batch_id")


@check(f"SELECT {_MESSAGE}, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END::BIGINT AS batch_id FROM events")
def stream_restart(spark, d):
    """Messages that arrive after a stop are taken up from the checkpoint, the earlier ones not again."""
    base = shared_folder(spark)
    for half in (_EARLY, f"NOT {_EARLY}"):
        _publish(_messages(spark, d).filter(half), f"{base}/in")
        rows = actions.parsed(actions.file_messages(spark, f"{base}/in"))
        actions.run_once(rows, actions.slice_writer(f"{base}/out"), f"{base}/checkpoint")
    return actions.read_slices(spark, f"{base}/out", _COLUMNS).drop("query")


@check(
    """SELECT 'cut off {"user_id":"' || user_id || '"' AS message FROM events WHERE event_type = 'view'"""
)
def stream_rejects(spark, d):
    base = shared_folder(spark)
    cut = F.concat(F.lit('cut off {"user_id":"'), "user_id", F.lit('"')).alias("value")
    bad = table(spark, d, "events").filter("event_type = 'view'").select(cut)
    good = _messages(spark, d).filter("event_type != 'view'").select("value")
    _publish(good.unionByName(bad), f"{base}/in")
    write = actions.rejecting_writer(f"{base}/out", f"{base}/rejects")
    actions.run_once(actions.file_messages(spark, f"{base}/in"), write, f"{base}/checkpoint")
    return actions.read_slices(spark, f"{base}/rejects", {"message": "string"}).drop("query", "batch_id")


@check(f"SELECT DISTINCT {_MESSAGE} FROM events")
def stream_once(spark, d):
    """Messages that are sent twice, in one batch and in two, and a batch that is delivered twice: every message is one row."""
    base = shared_folder(spark)
    write = actions.ledgered(actions.slice_writer(f"{base}/out"), f"{base}/ledger")
    for part in (_EARLY, "true"):
        twice = _messages(spark, d).filter(part)
        _publish(twice.unionByName(twice.filter("event_type = 'view'")), f"{base}/in")
        sent = actions.timed(actions.parsed(actions.file_messages(spark, f"{base}/in")))
        rows = actions.once_per_message(sent, [f.name for f in ACTION.fields], "time", "100 days").drop("time")
        actions.run_once(rows, write, f"{base}/checkpoint")
    # the batches come again, and a slice is there that was never entered
    place = f"query={actions.query_id(spark, f'{base}/checkpoint')}/batch_id="
    again = actions.parsed(_messages(spark, d).select("value"))
    write(again, f"{place}0")
    actions.slice_writer(f"{base}/out")(again, f"{place}999")
    return actions.committed(spark, f"{base}/out", f"{base}/ledger", _COLUMNS).drop("query", "batch_id")


@check(
    """SELECT user_id::VARCHAR AS user_id FROM (SELECT DISTINCT ON (user_id) user_id, event_type FROM events
    ORDER BY user_id, ts DESC, event_id DESC) WHERE event_type = 'signup'"""
)
def stream_current_subscribers(spark, d):
    """State kept from the stream over a restart; every batch stores the users it changed, and a snapshot holds the
    batches before it."""
    base = shared_folder(spark)
    # the later half comes first, so that late actions must not undo newer ones
    for half in (f"NOT {_EARLY}", _EARLY):
        _publish(_messages(spark, d).filter(half), f"{base}/in")
        rows = actions.parsed(actions.file_messages(spark, f"{base}/in"))
        report.keep_subscribers(rows, f"{base}/state", f"{base}/checkpoint")
        if half != _EARLY:
            actions.take_snapshot(spark, f"{base}/state", "user_id", "action", report.STATE_COLUMNS)
    return report.streamed_subscribers(spark, f"{base}/state")

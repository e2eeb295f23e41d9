"""Latest-event report: messages, recipients and the outbox of what has not been sent."""

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringledger.operators.incremental import unsent
from ringledger.operators.joins import fan_out, with_text
from ringledger.operators.latest import current_subscribers, top_row
from ringledger.operators.report import report_messages
from ringledger.schemas import NOTIFICATIONS
from ringledger.sources import files, versions
from ringledger.streaming import actions


def latest_event(events: DataFrame) -> DataFrame:
    """Newest dated event; of several on one day the first by name."""
    return top_row(events, "date", ["event_name"]).select("event_name", "location", "date")


def latest_report(events: DataFrame, fights: DataFrame) -> DataFrame:
    return report_messages(latest_event(events), fights)


def subscribers(log: DataFrame) -> DataFrame:
    """Users subscribed now. Timestamps are compared as times, which their text need not be."""
    return current_subscribers(actions.timed(log), "user_id", "action", ["time", "timestamp", "action"])


STATE_COLUMNS = {"user_id": "string", "action": "string", "at": "struct<time:timestamp,timestamp:string>"}


def streamed_subscribers(spark: SparkSession, base: str) -> DataFrame:
    """Users subscribed now, from the states a stream keeps below `base`: the newest snapshot and what came after it."""
    return actions.subscribed(actions.current_states(spark, base, "user_id", "action", STATE_COLUMNS), "user_id", "action")


def keep_subscribers(messages: DataFrame, base: str, checkpoint: str) -> None:
    """Take up the action messages that have arrived into the states below `base`."""
    rows = actions.timed(messages.filter("user_id IS NOT NULL"))
    states = actions.subscriber_states(rows, "user_id", "action", ["time", "timestamp"])
    actions.run_once(states, actions.slice_writer(f"{base}/slices"), checkpoint, mode="update")


MESSAGE = ["event_name", "kind"]


def outbox(recipients: DataFrame, messages: DataFrame) -> DataFrame:
    """(user_id, event_name, kind) for each recipient and message; order by kind to send."""
    return fan_out(recipients.select("user_id"), messages, MESSAGE)


def stored_outbox(spark: SparkSession, recipients: DataFrame, messages: DataFrame, path: str) -> DataFrame:
    """Outbox over messages that are written first, so that they are computed once."""
    files.overwrite(messages, path)
    return outbox(recipients, spark.read.parquet(path))


def deliveries(box: DataFrame, messages: DataFrame) -> DataFrame:
    """What is to be sent: the rows of an outbox with their texts, which are stored once per event."""
    return with_text(box, messages, MESSAGE).select("user_id", *MESSAGE, "text")


def notify(spark: SparkSession, warehouse: str, recipients: DataFrame, sent_path: str, outbox_path: str) -> bool:
    """Write the outbox of the latest event unless it was notified before; True if it was written.

    The slice of the event is overwritten, and the notification is recorded after it: a failure in between repeats
    the slice and neither loses nor doubles messages.
    """
    events, fights = (versions.read_current(spark, f"{warehouse}/{name}") for name in ("events", "fights"))
    sent = files.read_table(spark, sent_path, NOTIFICATIONS)
    new = unsent(latest_event(events), sent, "event_name").first()
    if new is None:
        return False
    event = spark.createDataFrame([new], "event_name string, location string, date date")
    slice_name = f"event={hashlib.md5(new['event_name'].encode()).hexdigest()}"
    box = stored_outbox(spark, recipients, report_messages(event, fights), f"{outbox_path}_messages/{slice_name}")
    files.overwrite(box, f"{outbox_path}/{slice_name}")
    row = event.select(F.current_timestamp().alias("sent_at"), "event_name", F.col("date").alias("event_date"))
    row.write.mode("append").parquet(sent_path)
    return True

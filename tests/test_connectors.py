"""Settings of the database and broker connectors, which cannot be reached here."""

import pytest
from pyspark.errors import AnalysisException

from ringledger.sources import files
from ringledger.streaming import actions


class Recorder:
    """Stands for a DataFrame and its writer; keeps what is set."""

    def __init__(self):
        self.set = {}

    @property
    def write(self):
        return self

    def format(self, name):
        self.set["format"] = name
        return self

    def options(self, **options):
        self.set |= options
        return self

    def mode(self, mode):
        self.set["mode"] = mode
        return self

    def save(self):
        self.set["saved"] = True


def test_jdbc_overwrite_keeps_the_table_definition():
    df = Recorder()
    files.write_jdbc(df, "jdbc:x", "events", user="u")
    assert df.set == {
        "format": "jdbc",
        "url": "jdbc:x",
        "dbtable": "events",
        "batchsize": "10000",
        "numPartitions": "16",
        "truncate": "true",
        "user": "u",
        "mode": "overwrite",
        "saved": True,
    }


def test_jdbc_batches_are_appended():
    df = Recorder()
    actions.jdbc_writer("jdbc:x", "user_actions", user="u")(df, "batch_id=3")
    assert df.set == {"format": "jdbc", "url": "jdbc:x", "dbtable": "user_actions", "user": "u", "mode": "append", "saved": True}


def test_kafka_needs_its_connector(spark):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        actions.kafka_messages(spark, "broker:9092", "topic")

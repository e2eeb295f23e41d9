"""JSON actions: source, parsing, and sinks that survive a repeated batch."""

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ringledger.operators.latest import newest_slice
from ringledger.schemas import ACTION
from ringledger.sources.files import exists, read_table
from ringledger.sources.versions import names_in, write_text
from ringledger.values import SUBSCRIBE, UNSUBSCRIBE

KAFKA = {"startingOffsets": "earliest", "failOnDataLoss": "false"}


def kafka_messages(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Topic values as text, from the earliest offset, going on where offsets were lost."""
    settings = {"kafka.bootstrap.servers": servers, "subscribe": topic, **KAFKA, **options}
    return spark.readStream.format("kafka").options(**settings).load().select(F.col("value").cast("string"))


def file_messages(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines of text files in a folder as they arrive."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def parsed(
    messages: DataFrame, schema: T.StructType = ACTION, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Message text to columns, behind the columns to keep; a malformed message is a row of NULLs."""
    return messages.select(*keep, F.from_json(value, schema).alias("_data")).select(*keep, "_data.*")


def split_rejects(messages: DataFrame, schema: T.StructType = ACTION, value: str = "value"):
    """(rows, rejects): parsed rows of the readable messages, and the text of the others."""
    corrupt = "_corrupt"
    wide = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    options = {"columnNameOfCorruptRecord": corrupt}
    both = messages.select(value, F.from_json(value, wide, options).alias("data"))
    bad = F.col("data").isNull() | F.col(f"data.{corrupt}").isNotNull()
    names = [f"data.{f.name}" for f in schema.fields]
    return both.filter(~bad).select(*names), both.filter(bad).select(F.col(value).alias("message"))


def encoded(user_id: Column, username: Column, subscribe: Column, at: Column) -> Column:
    """JSON message of a subscription change; a missing user name is empty text."""
    return F.to_json(
        F.struct(
            user_id.alias("user_id"),
            F.coalesce(username, F.lit("")).alias("username"),
            F.when(subscribe, SUBSCRIBE).otherwise(UNSUBSCRIBE).alias("action"),
            at.alias("timestamp"),
            subscribe.cast("int").alias("subscribe"),
        )
    )


def publish(messages: DataFrame, servers: str, topic: str, **options) -> None:
    """Send the column `value` of a batch to a topic."""
    settings = {"kafka.bootstrap.servers": servers, "topic": topic, **options}
    messages.select("value").write.format("kafka").options(**settings).save()


#: Writes a batch to its place, the name of a slice that no other batch of any query has.
Writer = Callable[[DataFrame, str], None]


def slice_writer(folder: str) -> Writer:
    """Batch sink to Parquet: a batch that is replayed overwrites its own slice, and no other query's."""

    def write(batch: DataFrame, place: str) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/{place}")

    return write


def rejecting_writer(folder: str, rejects: str, schema: T.StructType = ACTION) -> Writer:
    """Batch sink that stores readable messages and the text of malformed ones apart."""

    def write(batch: DataFrame, place: str) -> None:
        batch.persist()
        try:
            rows, bad = split_rejects(batch, schema)
            slice_writer(folder)(rows, place)
            slice_writer(rejects)(bad, place)
        finally:
            batch.unpersist()

    return write


def ledgered(write: Writer, ledger: str) -> Writer:
    """`write`, but once for each place: a batch that the ledger knows is not written again.

    A place is entered by creating an empty file of its name when its rows are there, in one step. What was written without
    being entered counts as not written: `committed` leaves such slices out, and the repeat of the batch replaces them.
    """

    def once(batch: DataFrame, place: str) -> None:
        spark = batch.sparkSession
        if exists(spark, f"{ledger}/{place}"):
            return
        write(batch, place)
        write_text(spark, f"{ledger}/{place}", "")

    return once


def committed(spark: SparkSession, folder: str, ledger: str, columns: Mapping[str, str]) -> DataFrame:
    """The rows of the slices below `folder` that the ledger knows, with `query` and `batch_id`; the others are not opened."""
    known = [f"{q}/{b}" for q in names_in(spark, ledger) for b in names_in(spark, f"{ledger}/{q}")]
    ddl = T.StructType.fromDDL(", ".join([*(f"`{n}` {t}" for n, t in columns.items()), "query string, batch_id bigint"]))
    if not known:
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).option("basePath", folder).parquet(*[f"{folder}/{place}" for place in known])


def once_per_message(messages: DataFrame, key: Sequence[str], time: str, delay: str) -> DataFrame:
    """Streamed messages without repeats of the key, in one batch or over batches and restarts.

    A key is remembered until the newest message is `delay` later than it, which bounds the state.
    """
    return messages.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(key))


def jdbc_writer(url: str, table: str, **options) -> Writer:
    """Batch sink that appends to a database table.

    Use it with `ledgered`: a database cannot overwrite one batch, so a batch that is replayed would be appended again. What is
    left is a failure between the rows and the ledger; `ever_subscribed` and `current_subscribers` give the same users for
    repeated rows.
    """

    def write(batch: DataFrame, place: str) -> None:
        batch.write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()

    return write


def console_writer() -> Writer:
    """Print every row of a batch in full, for watching a stream by eye; rows come to the driver part by part."""

    def write(batch: DataFrame, place: str) -> None:
        for row in batch.toLocalIterator():
            print(place, *row, sep=" | ")

    return write


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the query that a checkpoint belongs to. It lives as long as the checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def start(
    rows: DataFrame,
    write: Writer,
    checkpoint: str,
    mode: str = "append",
    once: bool = False,
) -> StreamingQuery:
    """Start a stream into a batch sink. `once` takes what is there and ends; otherwise the default trigger runs on.

    A new checkpoint counts its batches from 0 again, so a slice is named by the query's id as well.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        write(batch, f"query={query_id(batch.sparkSession, checkpoint)}/batch_id={batch_id}")

    writer = rows.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_once(rows: DataFrame, write: Writer, checkpoint: str, mode: str = "append") -> None:
    start(rows, write, checkpoint, mode, once=True).awaitTermination()


def timed(actions: DataFrame, text: str = "timestamp") -> DataFrame:
    """Actions with the column `time`: their time text as a timestamp, so that its form does not decide the order."""
    return actions.withColumn("time", F.col(text).try_cast("timestamp"))


def subscriber_states(actions: DataFrame, user: str, action: str, order: list[str]) -> DataFrame:
    """Streaming aggregate: latest action and its place `at` per user. Its state is one row per user."""
    return actions.groupBy(user).agg(
        F.max_by(F.col(action), F.struct(*order)).alias(action), F.max(F.struct(*order)).alias("at")
    )


def read_slices(spark: SparkSession, folder: str, columns: Mapping[str, str]) -> DataFrame:
    """Stored batches with the given columns, `query` and `batch_id`; empty if none is stored."""
    ddl = ", ".join([*(f"`{n}` {t}" for n, t in columns.items()), "query string, batch_id bigint"])
    return read_table(spark, folder, T.StructType.fromDDL(ddl))


def latest_states(slices: DataFrame, user: str, action: str) -> DataFrame:
    """(user, action, at) of each user's latest state over all slices: by the time of the action, whichever batch or query
    stored it."""
    picked = slices.groupBy(user).agg(F.max_by(F.struct(action, "at"), F.struct("at", action)).alias("_state"))
    return picked.select(user, "_state.*")


def subscribed(states: DataFrame, user: str, action: str, wanted: str = SUBSCRIBE) -> DataFrame:
    return states.filter(F.col(action) == wanted).select(user)


_MARKS = "query string, batch_id bigint, snapshot bigint"


def _newest_snapshot(spark: SparkSession, base: str) -> tuple[int | None, dict[str, int]]:
    """Number of the newest complete snapshot, and the last batch of each query it holds."""
    marks = read_table(spark, f"{base}/snapshot_marks", T.StructType.fromDDL(_MARKS))
    rows = newest_slice(marks, "snapshot").collect()  # a row per query
    return (rows[0]["snapshot"] if rows else None), {r["query"]: r["batch_id"] for r in rows}


def current_states(spark: SparkSession, base: str, user: str, action: str, columns: Mapping[str, str]) -> DataFrame:
    """(user, action, at) from the newest snapshot and the slices after it; earlier slices are not read."""
    number, marks = _newest_snapshot(spark, base)
    slices = read_slices(spark, f"{base}/slices", columns)
    if number is None:
        return latest_states(slices, user, action)
    # conditions on partition columns: the slices that the snapshot holds are pruned
    later = ~F.col("query").isin(list(marks))
    for query, batch in marks.items():
        later = later | ((F.col("query") == query) & (F.col("batch_id") > batch))
    snapshot = spark.read.schema(", ".join(f"`{n}` {t}" for n, t in columns.items()))
    snapshot = snapshot.parquet(f"{base}/snapshots/snapshot={number}")
    return latest_states(slices.filter(later).select(*columns).unionByName(snapshot), user, action)


def take_snapshot(spark: SparkSession, base: str, user: str, action: str, columns: Mapping[str, str]) -> None:
    """Store the current states as one table, so that reading them costs the users, not all updates ever made.

    The marks are written last: a snapshot without marks does not count, and a repeat replaces it. Batches that arrive
    meanwhile are after the marks.
    """
    number, marks = _newest_snapshot(spark, base)
    slices = read_slices(spark, f"{base}/slices", columns)
    done = slices.groupBy("query").agg(F.max("batch_id").alias("batch_id")).collect()  # a row per query
    if not done:
        return
    upto = F.lit(False)
    for r in done:
        upto = upto | ((F.col("query") == r["query"]) & (F.col("batch_id") <= r["batch_id"]))
    known = slices.filter(upto).select(*columns)
    if number is not None:
        before = ~F.col("query").isin(list(marks))
        for query, batch in marks.items():
            before = before | ((F.col("query") == query) & (F.col("batch_id") > batch))
        old = spark.read.schema(", ".join(f"`{n}` {t}" for n, t in columns.items()))
        known = slices.filter(upto & before).select(*columns).unionByName(old.parquet(f"{base}/snapshots/snapshot={number}"))
    new = 0 if number is None else number + 1
    latest_states(known, user, action).write.mode("overwrite").parquet(f"{base}/snapshots/snapshot={new}")
    rows = spark.createDataFrame([(r["query"], r["batch_id"]) for r in done], "query string, batch_id bigint")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{base}/snapshot_marks/snapshot={new}")

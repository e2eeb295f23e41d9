"""Conversation context as tables: kept messages, prompt context, sessions and the last mentioned name."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringledger.functions.text import preview, trimmed
from ringledger.operators.blocks import ROWS_PER_BLOCK, carry_forward, running_sum
from ringledger.operators.latest import last_rows
from ringledger.values import KEPT_MESSAGES, PROMPT_MESSAGES, SUMMARY_MESSAGES


def _newest(order: Sequence[str]) -> list[Column]:
    return [F.desc(c) for c in order]


def kept_messages(messages: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last messages that a conversation keeps."""
    return last_rows(messages, keys, _newest(order), KEPT_MESSAGES)


def prompt_lines(messages: DataFrame, keys: Sequence[str], order: Sequence[str], role: str, content: str) -> DataFrame:
    """Shortened lines of the latest messages, for the next question."""
    rows = last_rows(messages, keys, _newest(order), PROMPT_MESSAGES)
    return rows.withColumn("line", preview(F.col(role), F.col(content)))


def summary_messages(messages: DataFrame, keys: Sequence[str], order: Sequence[str], content: str) -> DataFrame:
    """The latest messages without the blank ones; blanks still count towards the limit."""
    rows = last_rows(messages, keys, _newest(order), SUMMARY_MESSAGES)
    return rows.filter(trimmed(F.col(content)) != "")


def sessions(
    messages: DataFrame,
    reset: Column,
    keys: Sequence[str],
    position: Column,
    order: Sequence[str],
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Adds `session`: the number of resets so far, the reset row included."""
    flag = F.when(reset, 1).otherwise(0)
    return running_sum(messages, flag, keys, position, order, "session", rows_per_block)


def mentioned_name(result: DataFrame) -> Column:
    """First non-NULL text among the columns that hold a name; NULL if there is no such column."""
    columns = [
        F.col(f"`{f.name}`")
        for f in result.schema.fields
        if "name" in f.name.lower() and isinstance(f.dataType, T.StringType)
    ]
    return F.coalesce(*columns) if columns else F.lit(None).cast("string")


def mention_of_result(result: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row with the name that a result mentions: that of its last row, by `order`, which holds one.

    This is what goes into `last_mention` for the message that asked. An aggregate, so any size of result sends one
    candidate per task.
    """
    named = result.select(*order, mentioned_name(result).alias("mention")).filter("mention IS NOT NULL")
    return named.agg(F.max_by("mention", F.struct(*order)).alias("mention"))


def last_mention(
    messages: DataFrame,
    mention: Column,
    keys: Sequence[str],
    position: Column,
    order: Sequence[str],
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Adds `mention`: the name mentioned last up to each message."""
    return carry_forward(messages, mention, keys, position, order, "mention", rows_per_block)

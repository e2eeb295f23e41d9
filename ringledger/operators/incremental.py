"""Selection of what is new since the last run, by ordering position against one-row bookmarks.

Positions are compared with scalar subqueries, so the listing itself is neither sorted nor shuffled.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _mark(mark: Column | str | None) -> Column:
    """A bookmark as a column; empty text counts as no bookmark."""
    column = mark if isinstance(mark, Column) else F.lit(mark).cast("string")
    return F.when(column.cast("string") != "", column)


def _positions(listing: DataFrame, name: str, position: str, **marks: Column) -> Column:
    """Struct with each mark and the first position that holds it, as one scalar."""
    marked = listing.select(
        F.col(position).alias("_p"), F.col(name).alias("_n"), *[m.alias(f"_{k}") for k, m in marks.items()]
    )
    fields = []
    for k in marks:
        fields.append(F.max(F.col(f"_{k}")).alias(k))
        fields.append(F.min(F.when(F.col("_n") == F.col(f"_{k}"), F.col("_p"))).alias(f"{k}_at"))
    return marked.agg(F.struct(*fields).alias("at")).scalar()


def since_bookmark(listing: DataFrame, name: str, position: str, mark: Column | str | None) -> DataFrame:
    """Rows after the first occurrence of the bookmark; all rows if it is absent or not listed."""
    at = _positions(listing, name, position, mark=_mark(mark))
    return listing.filter(at["mark_at"].isNull() | (F.col(position) > at["mark_at"]))


def gap_after_done(
    listing: DataFrame, name: str, position: str, upstream: Column | str | None, done: Column | str | None
) -> DataFrame:
    """Rows after `done` up to and including `upstream`, rule of the fights job.

    Nothing, if `done` is listed but `upstream` is not behind it; all rows without an upstream bookmark, or if
    neither is listed.
    """
    at = _positions(listing, name, position, upstream=_mark(upstream), done=_mark(done))
    here = F.col(position)
    return listing.filter(
        F.when(at["upstream"].isNull(), True)
        .when(at["done_at"].isNotNull(), (here > at["done_at"]) & F.coalesce(here <= at["upstream_at"], F.lit(False)))
        .when(at["upstream_at"].isNotNull(), here <= at["upstream_at"])
        .otherwise(True)
    )


def gap_up_to_known(
    listing: DataFrame, name: str, position: str, upstream: Column | str | None, done: Column | str | None
) -> DataFrame:
    """Rows after `done` up to and including `upstream`, rule of the statistics job.

    A `done` bookmark that is not listed blocks a listed `upstream`; without a listed `upstream` everything after
    `done` is taken.
    """
    at = _positions(listing, name, position, upstream=_mark(upstream), done=_mark(done))
    here = F.col(position)
    after_done = F.coalesce(here > at["done_at"], F.lit(False))
    return listing.filter(
        F.when(at["upstream_at"].isNotNull() & at["done"].isNull(), here <= at["upstream_at"])
        .when(at["upstream_at"].isNotNull(), after_done & (here <= at["upstream_at"]))
        .when(at["done_at"].isNotNull(), after_done)
        .otherwise(True)
    )


def not_yet_stored(df: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in the stored table; a NULL in a key equals a NULL.

    The stored keys, which grow with every run, are first reduced to those of the new rows, of which there are few: Spark
    broadcasts these where they are small, so the history is scanned but neither shuffled nor sorted.
    """

    def named(prefix: str) -> list[Column]:
        return [F.col(k).alias(f"{prefix}{k}") for k in keys]

    def same(left: str, right: str) -> list[Column]:
        return [F.col(f"{left}{k}").eqNullSafe(F.col(f"{right}{k}")) for k in keys]

    wanted = df.select(*named("_new_")).distinct()
    known = stored.select(*named("_old_")).join(wanted, same("_old_", "_new_"), "left_semi").distinct()
    return df.join(known, same("", "_old_"), "left_anti")


def unsent(events: DataFrame, sent: DataFrame, key: str) -> DataFrame:
    """Events without a notification so far."""
    return events.join(sent.select(key), key, "left_anti")

"""Closest stored name for a table of asked names, by edit distance.

A name within k edits of an asked one has, of k + 1 pieces it is cut into, one that stands unchanged in the asked name, moved by
k places at most. So names are indexed by their pieces (k + 1 rows each) under their length, asked names bring the pieces they
may share with names of each length (a bounded number), and only pairs that meet are compared. This is done for no edit, one
edit and so on, rarer pieces first, for the asked names that have found nothing yet. Those without a name within `NEAR` edits
are few; for these the names are scanned, so many of them at a time, with one candidate per task and asked
name. No pair of tables is multiplied, and the result is that of comparing all pairs.
"""

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringledger.session import shared_folder

#: Edits that the index covers, and asked names that one scan takes.
NEAR, SCANNED = 2, 1_000


def _edge(length: Column, piece: int, pieces: int) -> Column:
    """Place (from 0) where a piece of a name begins; the pieces of a name differ by one character at most."""
    return F.floor(length * piece / pieces).cast("int")


def _indexed(names: DataFrame, edits: int) -> DataFrame:
    """(name, length, piece, text): the pieces of each name; a name too short for them has empty ones, which all meet."""
    n, pieces = F.char_length("name"), edits + 1
    cut = [
        F.struct(
            F.lit(k).alias("piece"),
            F.substring("name", _edge(n, k, pieces) + 1, _edge(n, k + 1, pieces) - _edge(n, k, pieces)).alias("text"),
        )
        for k in range(pieces)
    ]
    return names.select("name", n.alias("length"), F.explode(F.array(*cut)).alias("p")).select("name", "length", "p.*")


def _offered(asked: DataFrame, edits: int) -> DataFrame:
    """(asked, length, piece, text): what a name of each length may have in common with the asked one."""
    pieces, n = edits + 1, F.char_length("asked")
    lengths = F.explode(F.sequence(F.greatest(n - edits, F.lit(0)), n + edits)).alias("length")
    rows = asked.select("asked", lengths).withColumn("piece", F.explode(F.array(*map(F.lit, range(pieces)))))
    length = F.col("length")

    def edge(more: int) -> Column:
        return F.floor(length * (F.col("piece") + more) / pieces).cast("int")

    size, n = edge(1) - edge(0), F.char_length("asked")
    first, last = F.greatest(edge(0) - edits, F.lit(0)), F.least(edge(0) + edits, n - size)
    starts = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    rows = rows.select("asked", "length", "piece", F.explode(starts).alias("start"), size.alias("size"))
    return rows.select("asked", "length", "piece", F.substring("asked", F.col("start") + 1, F.col("size")).alias("text")).distinct()


def _best(pairs: DataFrame) -> DataFrame:
    """(asked, best) of pairs (asked, name, distance): the least distance, then the least name."""
    return pairs.groupBy("asked").agg(F.min(F.struct("distance", "name")).alias("best"))


def _blocks(asked: DataFrame, size: int) -> Iterator[list[str]]:
    block = []
    for row in asked.select("asked").toLocalIterator():
        block.append(row["asked"])
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def closest_of_table(asked: DataFrame, asked_col: str, names: DataFrame, name_col: str, edits: int = NEAR) -> DataFrame:
    """(asked, closest, distance) for each different asked name: the stored name of the smallest edit distance, smallest first.

    Nulls are neither asked nor found; without any stored name nothing is closest and the result is empty.
    """
    spark, path = names.sparkSession, shared_folder(names.sparkSession)

    def stored(df: DataFrame, part: str) -> DataFrame:
        df.write.parquet(f"{path}/{part}")
        return spark.read.schema(df.schema).parquet(f"{path}/{part}")

    known = stored(names.select(F.col(name_col).alias("name")).where("name IS NOT NULL").distinct(), "names")
    wanted = stored(asked.select(F.col(asked_col).alias("asked")).where("asked IS NOT NULL").distinct(), "asked")
    on, parts = ["length", "piece", "text"], []
    for k in range(edits + 1):
        # both sides come from tables, so that Spark splits the rows of a very common piece
        index, offers = stored(_indexed(known, k), f"index-{k}"), stored(_offered(wanted, k), f"offers-{k}")
        distance = F.levenshtein("asked", "name", k).alias("distance")
        pairs = offers.join(index, on).select("asked", "name", distance).where("distance >= 0")
        parts.append(stored(_best(pairs), f"near-{k}"))
        wanted = stored(wanted.join(parts[-1], "asked", "left_anti"), f"left-{k}")
    for number, block in enumerate(_blocks(wanted, SCANNED)):
        each = known.select("name", F.explode(F.array(*map(F.lit, block))).alias("asked"))
        far = _best(each.select("asked", "name", F.levenshtein("asked", "name").alias("distance")))
        parts.append(stored(far, f"far-{number}"))
    found = reduce(DataFrame.unionByName, parts)
    return found.select("asked", F.col("best.name").alias("closest"), F.col("best.distance").alias("distance"))

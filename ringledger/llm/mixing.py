"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by source and exact length. A source whose target is b times its size and some more takes every
document b times; what is left of the budget is fitted on the counts by length: a proportional share of each length first,
carried on from length to length, and the rest by dynamic programming over a bounded knapsack, which finds counts that add
up to the budget or come nearest to it. Which documents of a length are taken is decided by a seeded hash.

Fitting reads one row per source and length. The lengths of a source are different numbers that add up to no more than its
words, so n words have at most sqrt(2 n) lengths, whatever the number of documents.
"""

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringledger.llm.common import stored

WEIGHTS = (5.0, 2.0, 1.0)
MOST_COPIES = 3
SEED = 11
#: Words of the knapsack's table; a larger rest is brought below it by whole documents first.
TABLE = 1 << 16
#: Documents of one length and source that are ranked together.
ROWS_PER_BLOCK = 100_000
#: Equal rows that one task writes out.
ROWS_PER_CHUNK = 10_000
_PART_BITS = 33


def words(text: Column) -> Column:
    """Number of words between ASCII white space; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> dict[str, Column]:
    """What makes two rows the same document: source, id, length, and a seeded hash of id and text."""
    source = F.col(source_col).cast("string")
    return {
        # no source and an empty name are two sources
        "_source": F.coalesce(F.concat(F.lit("="), source), F.lit("")),
        "_id": F.col(id_col),
        "_size": words(F.col(text_col)),
        "_hash": F.xxhash64(F.lit(SEED), F.col(id_col), F.col(text_col)),
    }


def knapsack(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of each size to take so that the sum is nearest to the budget; of two as near, the lower.

    Sizes are positive. Sums above twice the budget are further off than taking nothing.
    """
    limit = min(2 * budget, int(np.dot(sizes, counts)))
    reached = np.zeros(limit + 1, dtype=bool)
    reached[0] = True
    through = np.full(limit + 1, -1, dtype=np.int32)
    for i in np.argsort(-sizes):
        size = int(sizes[i])
        last = reached.copy()
        for _ in range(min(int(counts[i]), limit // size)):
            new = np.zeros_like(reached)
            new[size:] = last[:-size]
            new &= ~reached
            if not new.any():
                break
            through[new] = i
            reached |= new
            last = new
        if limit >= budget and reached[budget]:
            break
    sums = np.flatnonzero(reached)
    at = int(sums[np.argmin(np.abs(sums - budget))])
    taken = np.zeros(len(sizes), dtype=np.int64)
    while at:
        taken[through[at]] += 1
        at -= int(sizes[through[at]])
    return taken


def _rest_fitted(sizes: np.ndarray, left: np.ndarray, rest: int) -> np.ndarray:
    """Counts for what is left of the budget: long documents until the knapsack's table can hold it, then the knapsack."""
    taken = np.zeros(len(sizes), dtype=np.int64)
    for most in (1, None):  # one of each length before more of one
        for i in np.argsort(-sizes):
            if rest <= TABLE:
                break
            n = min(int(left[i] - taken[i]), rest // int(sizes[i]))
            n = n if most is None else min(n, most)
            taken[i] += n
            rest -= n * int(sizes[i])
    usable = left > taken
    if rest <= TABLE:
        usable &= sizes <= 2 * max(rest, 1)
        if usable.any():
            taken[usable] += knapsack(sizes[usable], (left - taken)[usable], rest)
    elif usable.any():
        # every document left is longer than the rest
        i = int(np.argmin(np.where(usable, sizes, np.iinfo(np.int64).max)))
        taken[i] += int(sizes[i]) - rest < rest
    return taken


def fitted(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take for a budget of words below their sum; no length 0."""
    total = int(np.dot(sizes, counts))
    if budget <= 0 or not total:
        return np.zeros(len(sizes), dtype=np.int64)
    exact = counts * (budget / total)
    taken = np.minimum(np.floor(exact), counts).astype(np.int64)
    owed = 0.0
    for i in np.argsort(-sizes):  # what a length is short of is carried on to the next ones
        owed += (exact[i] - taken[i]) * sizes[i]
        if owed >= sizes[i] and taken[i] < counts[i]:
            taken[i] += 1
            owed -= sizes[i]
    rest = budget - int(np.dot(sizes, taken))
    for i in np.argsort(sizes):  # rounding may have taken a word too many
        while rest < 0 and taken[i]:
            taken[i] -= 1
            rest += int(sizes[i])
    best = taken + _rest_fitted(sizes, counts - taken, rest)
    if int(np.dot(sizes, best)) != budget:
        # give back one document of each length, short ones first, as many words as the knapsack's table can hold
        given, freed = taken.copy(), rest
        for i in np.argsort(sizes):
            while given[i] and freed + int(sizes[i]) <= TABLE and (budget <= TABLE or given[i] == taken[i]):
                given[i] -= 1
                freed += int(sizes[i])
        found = [best, given + _rest_fitted(sizes, counts - given, freed)]
        if budget > TABLE:
            # few and long documents: fit them in larger units, then the rest in words
            unit = budget // TABLE + 1
            long = knapsack(np.maximum(sizes // unit, 1), counts, budget // unit)
            rest = budget - int(np.dot(sizes, long))
            found.append(long + (_rest_fitted(sizes, counts - long, rest) if rest > 0 else 0))
        best = min(found, key=lambda k: abs(int(np.dot(sizes, k)) - budget))
    return best


def _fit(lengths: pd.DataFrame) -> pd.DataFrame:
    """Copies of all documents (`base`) and the number that is taken once more (`extra`) for each length of one source."""
    total, target = int(lengths["_total"].iloc[0]), float(lengths["_target"].iloc[0])
    base = min(MOST_COPIES, int(target // total)) if total else 0
    budget = 0 if base == MOST_COPIES else int(round(target - base * total))
    sizes, counts = lengths["_size"].to_numpy(np.int64), lengths["_count"].to_numpy(np.int64)
    extra, filled = np.zeros(len(sizes), dtype=np.int64), sizes > 0
    extra[filled] = fitted(sizes[filled], counts[filled], budget)
    return lengths[["_source", "_size", "_count"]].assign(_base=base, _extra=extra)


def _ranked(sources: DataFrame) -> DataFrame:
    """The sources with `_rank` from 0 by code point, null last; a distributed sort and one offset per part."""
    ordered = sources.orderBy(F.col("_source") == "", "_source").withColumn("_place", F.monotonically_increasing_id())
    ordered = stored(sources.sparkSession, ordered).withColumn("_part", F.shiftright("_place", _PART_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ordered.groupBy("_part").agg(F.count("*").alias("_n"))  # a row per partition of the sort
    parts = parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rank = F.col("_before") + F.col("_place").bitwiseAND((1 << _PART_BITS) - 1)
    return ordered.join(F.broadcast(parts), "_part").select(*sources.columns, rank.alias("_rank"))


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """(_source, _total, _target) of the sources (_source, _total).

    All words are shared by weight; the weights repeat over the sources in code-point order. A target stops at three times
    its source's size, and the excess is shared by weight among the others until none is above: that is, every target is the
    least of its bound and one level times its weight. Each round is an aggregate of the sources.
    """
    choice = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    bound = (F.col("_total") * MOST_COPIES).cast("double")
    known = stored(sources.sparkSession, _ranked(sources).select("_source", "_total", choice.alias("_weight")))
    total, weight = known.agg(F.sum("_total"), F.sum("_weight")).first()
    level, capped = (total / weight if weight else 0.0), 0
    while weight:
        full = bound <= F.lit(level) * F.col("_weight")
        n, held, free = known.agg(
            F.count(F.when(full, 1)), F.sum(F.when(full, F.col("_total") * MOST_COPIES)), F.sum(F.when(~full, F.col("_weight")))
        ).first()
        if n == capped or not free:
            break
        level, capped = (total - held) / free, n
    return known.select("_source", "_total", F.least(bound, F.lit(level) * F.col("_weight")).alias("_target"))


def _chosen(items: DataFrame, weights: Sequence[float]) -> DataFrame:
    """The documents with `_copies` of each of their rows and `_more`, the number of rows that get one copy more."""
    spark = items.sparkSession
    lengths = stored(spark, items.groupBy("_source", "_size").agg(F.sum("_rows").alias("_count")))
    totals = lengths.groupBy("_source").agg(F.sum(F.col("_size") * F.col("_count")).alias("_total"))
    goal = stored(spark, targets(totals, weights))
    kind = "_source string, _size long, _count long, _base long, _extra long"
    fit = lengths.join(goal, "_source").groupBy("_source").applyInPandas(_fit, kind)
    plan = stored(spark, fit.join(goal, "_source"))
    block = F.floor((F.col("_hash") / 2.0**64 + 0.5) * F.col("_blocks")).cast("long")
    dealt = (
        items.join(plan, ["_source", "_size"])
        .withColumn("_blocks", F.ceil(F.col("_count") / ROWS_PER_BLOCK))
        .withColumn("_block", F.least(block, F.col("_blocks") - 1))
    )
    # a length with very many documents is ranked block by block, and blocks by their sums
    key = ["_source", "_size", "_block"]
    blocks = dealt.where("_blocks > 1").groupBy(key).agg(F.sum("_rows").alias("_n"))
    ahead = Window.partitionBy("_source", "_size").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*key, F.sum("_n").over(ahead).alias("_ahead"))
    zero = F.lit(0).cast("long")
    here = Window.partitionBy(*key).orderBy("_hash", "_id").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce("_ahead", zero) + F.coalesce(F.sum("_rows").over(here), zero)
    more = F.greatest(zero, F.least(F.col("_rows"), F.col("_extra") - before))
    return dealt.join(blocks, key, "left").withColumn("_more", more).withColumnRenamed("_base", "_copies")


def _items(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """One row per document with the number of its equal rows; reduced in each task before the shuffle."""
    keys = _keyed(docs, id_col, text_col, source_col)
    narrow = docs.select(*[c.alias(n) for n, c in keys.items()])
    return stored(docs.sparkSession, narrow.groupBy(*keys).agg(F.count("*").alias("_rows")))


def _per_row(items: DataFrame) -> DataFrame:
    """One row per row of the documents with its number `_row` from 1; very many equal ones are written by many tasks."""
    few = items.where(F.col("_rows") <= ROWS_PER_CHUNK).withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), "_rows")))
    chunks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_rows") - 1) / ROWS_PER_CHUNK))
    many = items.where(F.col("_rows") > ROWS_PER_CHUNK).withColumn("_chunk", F.explode(chunks)).repartition("_hash", "_chunk")
    first = F.col("_chunk") * ROWS_PER_CHUNK
    in_chunk = F.sequence(first + 1, F.least(first + ROWS_PER_CHUNK, F.col("_rows")))
    return few.unionByName(many.withColumn("_row", F.explode(in_chunk)).drop("_chunk"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
) -> DataFrame:
    """One row per row of `docs`: id, source, size, source_size, target, copies, taken (words: copies times size).

    The words taken of a source come nearest to its target that whole documents allow, as far as lengths of up to 65,536
    words decide it; no document is taken more than three times. Rows with the same id, source and text are interchangeable
    and counted together; a null text has no words, and a text without words is taken with its source but adds none. A null
    source is a source, the last one; null ids are allowed. The result depends on the rows alone, not on their order or
    partitions. Other columns are ignored. An empty table gives an empty one.
    """
    rows = _per_row(_chosen(_items(docs, id_col, text_col, source_col), weights))
    copies = F.col("_copies") + (F.col("_row") <= F.col("_more")).cast("long")
    return rows.select(
        F.col("_id").alias(id_col),
        F.when(F.col("_source") != "", F.substring("_source", 2, 1 << 30)).alias(source_col),
        F.col("_size").alias("size"),
        F.col("_total").alias("source_size"),
        F.col("_target").alias("target"),
        copies.alias("copies"),
        (copies * F.col("_size")).alias("taken"),
    )


def mixture(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
) -> DataFrame:
    """The mix itself: the rows of `docs`, each as often as `mix` takes it. The texts are moved once.

    Of rows with the same id, source and text one stands for all, with its other columns.
    """
    keys = _keyed(docs, id_col, text_col, source_col)
    taken = _chosen(_items(docs, id_col, text_col, source_col), weights)
    taken = taken.select(*keys, (F.col("_rows") * F.col("_copies") + F.col("_more")).alias("_times")).where("_times > 0")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_whole"), *[c.alias(n) for n, c in keys.items()])
    one = whole.dropDuplicates(list(keys))
    same = [one[c].eqNullSafe(taken[c]) for c in keys]
    times = F.explode(F.sequence(F.lit(1).cast("long"), "_times"))
    return one.join(taken, same).select("_whole", times).select("_whole.*")

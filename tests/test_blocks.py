"""Block-wise running state against a plain loop, with one key that holds most rows."""

import random

import pytest
from pyspark.sql import functions as F

from ringledger.operators import blocks


def made(seed, n=600):
    r = random.Random(seed)
    out = []
    for i in range(n):
        key = None if r.random() < 0.1 else "hot" if r.random() < 0.6 else f"k{r.randrange(20)}"
        # clustered positions with ties on the first order column
        at = r.randrange(50) if r.random() < 0.5 else 10_000 + r.randrange(5000)
        out.append((i, key, at, r.choice([None, None, None, "x", "y", "z"])))
    return out


@pytest.mark.parametrize("rows_per_block", [1, 7, 50, 10_000])
def test_running_state(spark, rows_per_block):
    data = made(rows_per_block)
    df = spark.createDataFrame(data, "i int, k string, at int, v string").repartition(5)
    args = (["k"], F.col("at"), ["at", "i"])
    carried = blocks.carry_forward(df, F.col("v"), *args, "seen", rows_per_block)
    summed = blocks.running_sum(df, F.when(F.col("v") == "x", 1).otherwise(0), *args, "n", rows_per_block)
    last, count, want_seen, want_n = {}, {}, {}, {}
    for i, k, at, v in sorted(data, key=lambda x: (x[2], x[0])):
        last[k] = v if v is not None else last.get(k)
        count[k] = count.get(k, 0) + (v == "x")
        want_seen[i], want_n[i] = last[k], count[k]
    assert {r.i: r.seen for r in carried.collect()} == want_seen
    assert {r.i: r.n for r in summed.collect()} == want_n


def test_only_large_keys_are_cut_and_blocks_rise_with_the_position(spark):
    hot = spark.range(1000).select(F.lit("hot").alias("k"), F.col("id").alias("at"))
    cold = spark.range(90).select(F.concat(F.lit("k"), F.col("id") % 9).alias("k"), (F.col("id") * 7).alias("at"))
    df = hot.union(cold)
    large = blocks.large_keys(df, "k", F.col("at"), 100)
    assert [(r.k, r._blocks) for r in large.collect()] == [("hot", 10)]
    got = blocks.with_block(df, large, "k", F.col("at")).collect()
    numbers = [r._block for r in sorted(got, key=lambda r: r.at) if r.k == "hot"]
    assert numbers == sorted(numbers) and all(90 <= numbers.count(b) <= 110 for b in range(10))
    assert {r._block for r in got if r.k != "hot"} == {0}


def test_one_far_off_position_does_not_gather_a_key(spark):
    far = spark.range(1).select(F.lit("hot").alias("k"), F.lit(10**15).alias("at"))
    df = spark.range(10_000).select(F.lit("hot").alias("k"), F.col("id").alias("at")).union(far)
    large = blocks.large_keys(df, "k", F.col("at"), 100)
    sizes = [r[0] for r in blocks.with_block(df, large, "k", F.col("at")).groupBy("_block").count().select("count").collect()]
    assert len(sizes) >= 95 and max(sizes) <= 320


def test_ties_stay_together(spark):
    df = spark.range(5_000).select(F.lit("hot").alias("k"), (F.col("id") % 3).alias("at"))
    large = blocks.large_keys(df, "k", F.col("at"), 100)
    got = blocks.with_block(df, large, "k", F.col("at")).select("at", "_block").distinct().collect()
    assert len(got) == 3 and [r.at for r in sorted(got, key=lambda r: r._block)] == [0, 1, 2]


def test_rows_are_shuffled_once(spark, tmp_path):
    spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("at"), F.lit("x").alias("v")).write.parquet(
        str(tmp_path / "t")
    )
    df = spark.read.parquet(str(tmp_path / "t"))
    seen = blocks.carry_forward(df, F.col("v"), ["k"], F.col("at"), ["at"], "seen", 100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = seen._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # left side of the last join: the rows, with one exchange between the scan and the window
    rows_side = plan[plan.index("SortMergeJoin") : plan.index("BroadcastExchange")]
    assert rows_side.count("Exchange") == 1 and rows_side.count("Window [") == 1


def test_empty_table(spark):
    df = spark.createDataFrame([], "k string, at bigint, v string")
    assert blocks.carry_forward(df, F.col("v"), ["k"], F.col("at"), ["at"], "seen").collect() == []

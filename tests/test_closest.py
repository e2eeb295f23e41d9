"""Closest names for a table of asked names against comparing all pairs."""

import random

from pyspark.sql import functions as F

from ringledger.operators import closest
from tests.conftest import rows


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def made(seed, count):
    dice = random.Random(seed)
    names = {"".join(dice.choice("abé") for _ in range(dice.randrange(0, 9))) for _ in range(count)}
    names |= {"Jon Jones", "Jón Jones", "Jo", "a", ""}
    asked = set()
    for name in sorted(names):
        w = list(name)
        for _ in range(dice.randrange(5)):
            at = dice.randrange(len(w) + 1)
            w[at : at + dice.randrange(2)] = [dice.choice("abéx")] * dice.randrange(2)
        asked.add("".join(w))
    return sorted(names), sorted(asked | {"completely different", "zzzzzzzz"})


def test_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(closest, "SCANNED", 3)
    names, asked = made(5, 150)
    got = closest.closest_of_table(
        spark.createDataFrame([(a,) for a in [*asked, asked[0], None]], "a string"),
        "a",
        spark.createDataFrame([(n,) for n in [*names, *names, None]], "n string"),
        "n",
    )
    want = [(a, *min((distance(a, n), n.encode(), n) for n in names)[::-2]) for a in asked]
    assert rows(got) == sorted(want, key=repr)
    assert {0, 1, 2} < {r[2] for r in want}


def test_nothing_asked_or_stored(spark):
    none, some = spark.createDataFrame([], "x string"), spark.createDataFrame([("a",)], "x string")
    assert closest.closest_of_table(none, "x", some, "x").collect() == []
    assert closest.closest_of_table(some, "x", none, "x").collect() == []


def test_no_product_and_sizes_of_the_index(spark):
    names = spark.createDataFrame([("abcdefg",), ("xy",)], "name string")
    index = closest._indexed(names, 2).orderBy("piece").collect()
    assert ["".join(r["text"] for r in index if r["name"] == n) for n in ("abcdefg", "xy")] == ["abcdefg", "xy"]
    assert len(index) == 6
    got = closest.closest_of_table(names.withColumn("name", F.upper("name")), "name", names, "name")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan

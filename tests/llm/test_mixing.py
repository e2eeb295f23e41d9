import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ringledger.llm import mixing
from tests.llm import plain

DDL = "doc_id long, text string, source string"


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def shared_out(sizes):
    """Targets as the rule says it: shares by weight, those above the bound stop there, the excess goes to the others."""
    names = sorted((s for s in sizes if s is not None), key=str.encode) + [s for s in sizes if s is None]
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    target, still = {}, set(names)
    while still:
        rest = sum(sizes.values()) - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in still) for s in still}
        above = {s for s in still if share[s] > 3 * sizes[s]}
        if not above:
            return target | share
        target |= {s: 3.0 * sizes[s] for s in above}
        still -= above
    return target


def docs(spark, rows):
    clash = ["size", "_size", "_source", "_id", "_hash", "_rows", "copies", "target", "_total", "_row", "_block"]
    return spark.createDataFrame(rows, DDL).select("*", *[F.lit("clash").alias(c) for c in clash])


def held(got, rows):
    """Checks what must hold for every mix; (source: words taken, target)."""
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += n_words(text)
    sizes = {s: sizes[s] for s in {r[2] for r in rows}}
    goal = shared_out(sizes)
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, n_words(t)) for i, t, _ in rows)
    taken = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(goal[r["source"]], rel=1e-12)
        assert r["taken"] == r["size"] * r["copies"] and 0 <= r["copies"] <= 3
        taken[r["source"]] += r["taken"]
    return {s: (taken[s], goal[s]) for s in sizes}


def test_knapsack_against_all_subsets():
    dice = random.Random(3)
    for _ in range(300):
        sizes = np.array(dice.sample(range(1, 30), dice.randint(1, 4)))
        counts = np.array([dice.randint(1, 3) for _ in sizes])
        sums = {int(np.dot(sizes, k)) for k in itertools.product(*[range(c + 1) for c in counts])}
        budget = dice.randrange(0, int(np.dot(sizes, counts)))
        for find in (mixing.knapsack, mixing.fitted):
            if budget == 0 and find is mixing.knapsack:
                continue
            got = find(sizes, counts, budget)
            assert (got <= counts).all() and (got >= 0).all()
            # of two sums as near, either one
            assert abs(int(np.dot(sizes, got)) - budget) == min(abs(s - budget) for s in sums)


def test_large_budgets_are_met_exactly():
    sizes = np.arange(1, 5_000)
    counts = 1 + (sizes * 7919) % 40
    for budget in (1_000_003, 100_000_007, int(np.dot(sizes, counts)) - 1):
        got = mixing.fitted(sizes, counts, budget)
        assert (got <= counts).all() and int(np.dot(sizes, got)) == budget


def test_texts_longer_than_the_table():
    sizes, counts = np.array([100_000, 300_000]), np.array([2, 2])
    for budget, best in ((150_001, 200_000), (149_999, 100_000), (40_000, 0), (330_000, 300_000)):
        assert int(np.dot(sizes, mixing.fitted(sizes, counts, budget))) == best


def test_given_documents(spark):
    df = plain.table(spark, "documents", plain.MIDDLE).select("doc_id", "text", "source")
    rows = [tuple(r) for r in df.collect()]
    for words, target in held(mixing.mix(df).collect(), rows).values():
        assert abs(words - target) <= 1 + target / 5_000  # a source has some fifty documents


def test_odd_rows_and_hot_source(spark):
    names = [None, "", "a", "B", "é", "a"]
    rows = [(i, t, names[k % 6]) for k, (i, t) in enumerate(plain.ODD)]
    rows += [(i, "word " * (i % 7), "hot") for i in range(500)] + [(77, "one row many times", "hot")] * 400
    found = held(mixing.mix(docs(spark, rows)).collect(), rows)
    assert abs(found["hot"][0] - found["hot"][1]) <= 1
    assert found[""] == (0, 0) or found[""][0] >= 0


def test_the_order_of_rows_does_not_matter(spark, monkeypatch):
    rows = [(i, "w " * (1 + i * 31 % 23), f"s{i % 4}") for i in range(600)] + [(5, "twice", "s1")] * 2
    first = plain.rows(mixing.mix(docs(spark, rows)))
    # blocks and chunks of a few rows decide nothing but how the work is cut
    monkeypatch.setattr(mixing, "ROWS_PER_CHUNK", 1)
    again = plain.rows(mixing.mix(docs(spark, rows[::-1]).repartition(7)))
    assert first == again
    monkeypatch.setattr(mixing, "ROWS_PER_BLOCK", 3)
    blocks = mixing.mix(docs(spark, rows)).collect()
    held(blocks, rows)
    assert plain.rows(mixing.mix(docs(spark, rows))) == first


def test_mixture_holds_what_is_taken(spark):
    rows = [(i, "w " * (1 + i % 9), f"s{i % 3}") for i in range(90)] + [(5, "twice", "s1")] * 3 + [(None, "no id", None)]
    df = docs(spark, rows)
    times = defaultdict(int)
    for r in mixing.mix(df).collect():
        times[r["doc_id"], r["source"], r["size"]] += r["copies"]
    got = mixing.mixture(df)
    assert got.columns == df.columns
    assert Counter((r["doc_id"], r["source"], n_words(r["text"])) for r in got.collect()) == Counter(+Counter(times))


def test_empty(spark):
    assert mixing.mix(docs(spark, [])).collect() == []
    assert mixing.mixture(docs(spark, [])).collect() == []


def test_no_words_at_all(spark):
    got = mixing.mix(docs(spark, [(1, None, "a"), (2, " ", None)])).collect()
    assert {(r["size"], r["taken"], r["target"]) for r in got} == {(0, 0, 0.0)}

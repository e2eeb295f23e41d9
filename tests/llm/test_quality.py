import itertools

import numpy as np
from pyspark.sql import functions as F

from ringledger.llm import quality as Q
from ringledger.llm import queries
from ringledger.llm.common import agreed_labels
from tests.llm import plain


def test_marginals_against_enumeration():
    rng = np.random.default_rng(1)
    lines = np.array([3, 1, 5, 2])
    unary, tie = rng.normal(size=lines.sum()), rng.normal(size=(2, 2))
    odds = Q.Chains(lines).marginals(unary, tie)[2]
    start = 0
    for n in lines:
        mass = np.zeros((n, 2))
        for labels in itertools.product((0, 1), repeat=int(n)):
            weight = np.exp(sum(unary[start + t] * y for t, y in enumerate(labels)) + sum(tie[a, b] for a, b in itertools.pairwise(labels)))
            for t, y in enumerate(labels):
                mass[t, y] += weight
        assert np.allclose(odds[start : start + n], np.log(mass[:, 1] / mass[:, 0]))
        start += n


def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in queries.op1_quality(spark, plain.MIDDLE).collect()}
    labels = {r["doc_id"]: r["quality"] for r in plain.table(spark, "labels", plain.MIDDLE).collect()}
    held = [(labels[i], r["predicted"]) for i, r in got.items() if r["held_out"] and i in labels]
    assert np.mean([a == b for a, b in held]) >= 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got.values())


def test_held_out_labels_teach_nothing(spark):
    docs, labels = plain.table(spark, "documents"), plain.table(spark, "labels")
    held = queries.held_out("doc_id", 5, 0)
    other = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (Q.fit_quality(docs, x, queries.remainder("doc_id", 5) != 0) for x in (labels, other))
    assert np.array_equal(a.weights, b.weights) and a.slope == b.slope


def test_odd_rows(spark):
    docs, labels = plain.table(spark, "documents"), plain.table(spark, "labels")
    field = Q.fit_quality(docs, labels, F.lit(True))
    got = Q.score_documents(plain.documents(spark), field).collect()
    assert sorted((r["doc_id"] for r in got), key=str) == sorted((i for i, _ in plain.ODD), key=str)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert Q.score_documents(plain.documents(spark, []), field).collect() == []


def test_nothing_to_learn(spark):
    labels = spark.createDataFrame([(1, None), (None, 1), (6, 0), (6, 1)], "doc_id long, quality int")
    assert agreed_labels(labels, "doc_id", "quality").collect() == []
    field = Q.fit_quality(plain.documents(spark), labels, F.lit(True))
    assert {r["score"] for r in Q.score_documents(plain.documents(spark), field).collect()} == {0.5}


def test_line_labels(spark):
    docs, labels = plain.table(spark, "documents"), plain.table(spark, "labels")
    field = Q.fit_quality(docs, labels, F.lit(True))
    got = plain.documents(spark).select("text", Q.line_labels(field)("text").alias("p")).collect()
    assert all(len(r["p"]) == len((r["text"] or "").split("\n")) for r in got)


def test_scores_against_enumeration(spark):
    """The score of whole texts from every labelling of their lines."""
    field = Q.fit_quality(plain.table(spark, "documents"), plain.table(spark, "labels"), F.lit(True))
    texts = [t for _, t in plain.texts(spark) if t.count("\n") <= 8][:40] + ["", "one line", "a\n\nb\na\n"]
    assert sum("\n" in t for t in texts) > 5
    for text, score in zip(texts, field.scores(texts), strict=True):
        measures, lines, sizes = Q.measured([text])
        unary = field.features(measures, Q.Chains(lines)) @ field.weights
        good, total = np.zeros(len(unary)), 0.0
        for labels in itertools.product((0, 1), repeat=len(unary)):
            ties = sum(field.tie[a, b] for a, b in itertools.pairwise(labels))
            weight = np.exp(np.dot(unary, labels) + ties)
            good, total = good + weight * np.array(labels), total + weight
        q = np.clip((good / total * sizes).sum() / sizes.sum(), 1e-4, 1 - 1e-4)
        assert np.isclose(score, 1 / (1 + np.exp(-(field.slope * np.log(q / (1 - q)) + field.shift))))

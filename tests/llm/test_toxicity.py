import numpy as np
from pyspark.sql import functions as F

from ringledger.llm import queries
from ringledger.llm import toxicity as X
from tests.llm import plain

CALM = ["the weather is fine today", "we walked along the river", "bread and cheese for lunch", "a train left the station"]


def made(count):
    """Calm texts; every fifth has a rude word, every second of these is confirmed."""
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(count):
        text = " ".join(rng.choice(CALM, 4)) + " " + " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(12))
        if i % 5 == 0:
            text += " you " + rng.choice(["nastyword", "uglyterm", "rudeness"])
            if i % 10 == 0:
                labels.append((i, 1))
        rows.append((i, text))
    return rows, labels


def test_unlabelled_toxic_texts_are_found(spark):
    rows, labels = made(600)
    docs = plain.documents(spark, rows)
    model = X.fit_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True), F.lit(True), prior=0.2)
    got = {r["doc_id"]: r["predicted"] for r in X.score_documents(docs, model).collect()}
    assert all(got[i] == int(i % 5 == 0) for i in got)


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in queries.op9_toxicity(spark, folder).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in plain.table(spark, "labels", folder).collect()}
    held = [(labels[i], r["predicted"]) for i, r in got.items() if r["held_out"] and i in labels]
    assert np.mean([p for y, p in held if y == 1]) >= 0.9
    assert np.mean([p for y, p in held if y == 0]) <= 0.05
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got.values())


def test_risk_does_not_go_below_zero():
    # positives that are all alike and absent from the unlabelled: the model stays finite and tells them apart
    positive = [np.array([1, 2, k], np.uint32) for k in range(10, 20)]
    unlabelled = [np.array([k, k + 1], np.uint32) for k in range(100, 200)]
    model = X.fit_weights(positive, unlabelled, 0.3)
    assert set(model.weights) == {1, 2} and all(abs(w) < 50 for w in model.weights.values())


def test_odd_and_nothing_to_learn(spark):
    none = spark.createDataFrame([(1, None), (None, 1), (6, 0), (6, 1)], "doc_id long, toxic int")
    model = X.fit_toxicity(plain.documents(spark), none, F.lit(True), F.lit(True))
    got = X.score_documents(plain.documents(spark), model).collect()
    assert len(got) == len(plain.ODD) and {round(r["score"], 6) for r in got} == {0.01}
    one = spark.createDataFrame([(1, 1), (77, 1)], "doc_id long, toxic int")
    model = X.fit_toxicity(plain.documents(spark), one, F.lit(True), F.lit(True))
    assert len(X.score_documents(plain.documents(spark), model).collect()) == len(plain.ODD)
    assert X.score_documents(plain.documents(spark, []), model).collect() == []


def test_rare_telling_words_are_found(spark):
    """Held-out texts with one telling word each, every one of them in about 2.5 % of the positives."""
    rng = np.random.default_rng(9)
    calm = np.array([f"calm{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)])
    rude = [f"vile{chr(97 + i // 10)}{chr(97 + i % 10)}" for i in range(40)]
    rows, labels = [], []
    for i in range(12_000):
        words = list(rng.choice(calm, 20))
        if i % 10 == 0:
            words.insert(int(rng.integers(20)), rude[i // 10 % 40] if i % 20 else rude[i // 20 % 40])
            if rng.random() < 0.5:
                labels.append((i, 1))
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    learn = F.col("doc_id") < 9_600
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = X.fit_toxicity(docs, known, learn, learn, prior=0.1)
    got = {r["doc_id"]: r["predicted"] for r in X.score_documents(docs, model).collect() if r["doc_id"] >= 9_600}
    recall = np.mean([got[i] for i in got if i % 10 == 0])
    print(f"held-out recall for words in 2.5 % of the positives: {recall:.2f}")
    assert recall >= 0.85 and np.mean([got[i] for i in got if i % 10]) <= 0.02


def test_weights_have_the_least_risk():
    """No single weight or the bias can be moved to a lower non-negative risk; the risk is computed here from its formula."""
    rng = np.random.default_rng(5)
    positive = [np.unique(rng.choice([1, 2, 3, 50, 51, 52, 53], 4)).astype(np.uint32) for _ in range(60)]
    unlabelled = [np.unique(rng.choice([1, 50, 51, 52, 53, 54, 55], 3)).astype(np.uint32) for _ in range(200)]
    one, many, prior = X._once(positive), X._once(unlabelled), 0.3

    def risk(model):
        def f(docs):
            return np.array([model.bias + sum(model.weights.get(int(k), 0.0) for k in d) for d in docs])

        loss = lambda x: np.logaddexp(0.0, -x).mean()
        rest = loss(-f(many)) - prior * loss(-f(one))
        return prior * loss(f(one)) + max(0.0, rest) + X.L2 / 2 * sum(w * w for w in model.weights.values())

    model = X.fit_weights(positive, unlabelled, prior)
    least = risk(model)
    assert model.weights
    for step in (-0.3, 0.3):
        assert risk(X.Model(model.weights, model.bias + step)) > least - 1e-3
        for k in model.weights:
            assert risk(X.Model(model.weights | {k: model.weights[k] + step}, model.bias)) > least - 1e-3

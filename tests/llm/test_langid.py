import numpy as np
import pytest
from pyspark.sql import functions as F

from ringledger.llm import langid as L
from ringledger.llm import queries
from tests.llm import plain


@pytest.mark.parametrize("count", [1, 2, 3, 4, 6, 7, 30])
def test_codewords_differ(count):
    code = L.codewords(count)
    apart = (code.shape[1] - code @ code.T) / 2
    assert len(code) == count and (apart[~np.eye(count, dtype=bool)] >= min(1, code.shape[1])).all()
    if count >= 4:
        assert apart[~np.eye(count, dtype=bool)].min() >= 3  # one wrong bit is put right


def test_a_wrong_bit_is_corrected():
    model = L.Languages.__new__(L.Languages)
    model.names, model.code = list("abcd"), L.codewords(4)
    model.trust = np.full(7, 1 / 7)
    model.weights, model.bias = np.zeros((L.DIMENSIONS, 7), np.float32), (2 * model.code[2]).astype(np.float32)
    model.bias[1] *= -1
    assert model.predict(["word"])[0][0] == "c"


def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in queries.op3_language(spark, plain.MIDDLE).collect()}
    lang = {r["doc_id"]: r["lang"] for r in plain.table(spark, "documents", plain.MIDDLE).collect()}
    assert np.mean([got[i]["lang_pred"] == lang[i] for i in lang if got[i]["held_out"]]) >= 0.97


def test_odd_rows(spark):
    model = L.fit_languages(plain.table(spark, "documents"), F.lit(True))
    got = L.identify(plain.documents(spark), model).collect()
    unknown = {r["doc_id"] for r in got if r["lang_pred"] == "und"}
    assert unknown == {1, 2, 3, 4} and len(got) == len(plain.ODD)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert L.identify(plain.documents(spark, []), model).collect() == []


def test_few_languages(spark):
    rows = spark.createDataFrame([(1, None, "a b"), (2, "xx", None), (3, "xx", "")], "doc_id long, lang string, text string")
    assert L.fit_languages(rows, F.lit(True)) is None
    assert {r["lang_pred"] for r in L.identify(rows, None).collect()} == {"und"}
    one = spark.createDataFrame([(1, "xx", "some words")], "doc_id long, lang string, text string")
    got = L.identify(plain.documents(spark), L.fit_languages(one, F.lit(True))).collect()
    assert {r["lang_pred"] for r in got} == {"xx", "und"}
    two = spark.createDataFrame([(1, "xx", "some words"), (2, "yy", "жук")], "doc_id long, lang string, text string")
    got = L.identify(two, L.fit_languages(two, F.lit(True))).collect()
    assert {(r["doc_id"], r["lang_pred"]) for r in got} == {(1, "xx"), (2, "yy")}


def by_every_codeword(model, text):
    """Language, score and ambiguity by n-grams counted one by one and every codeword tried bit by bit, in plain Python."""
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0, True
    data = [b if b > 127 or chr(b).isalpha() else 32 for b in f" {text.lower()} ".encode()]
    counts = {}
    for i in range(len(data) - 1):
        two = data[i] << 8 | data[i + 1]
        grams = [two * 2246822519]
        if i + 2 < len(data):
            grams.append((two << 8 | data[i + 2]) * 2654435761 + 374761393)
        for g in grams:
            place = (g % 2**32) >> (32 - L.DIMENSIONS.bit_length() + 1)
            counts[place] = counts.get(place, 0) + 1
    total = sum(counts.values())
    bits = len(model.trust)
    votes = [float(model.bias[k]) + sum((n / total) ** 0.5 * float(model.weights[p, k]) for p, n in counts.items()) for k in range(bits)]
    losses = []
    for word in model.code:
        losses.append(sum(float(model.trust[k]) * np.log1p(np.exp(-word[k] * votes[k])) for k in range(bits)))
    order = sorted(range(len(losses)), key=losses.__getitem__)
    odds = [np.exp(-(x - losses[order[0]]) * bits) for x in losses]
    return model.names[order[0]], odds[order[0]] / sum(odds), losses[order[1]] - losses[order[0]] < L.MARGIN


def test_against_every_codeword(spark):
    model = L.fit_languages(plain.table(spark, "documents"), F.lit(True))
    texts = [t for _, t in plain.texts(spark)][:60] + [t for _, t in plain.ODD if t and len(t) < 1_000] + ["½ ²", "①②", "½a", "é"]
    for text, (lang, score, ambiguous) in zip(texts, model.predict(texts), strict=True):
        want = by_every_codeword(model, text)
        assert (lang, ambiguous) == (want[0], want[2]) and score == pytest.approx(want[1], abs=1e-3), text[:60]
    assert [x[0] for x in model.predict(["½ ²", "①②", None])] == ["und"] * 3

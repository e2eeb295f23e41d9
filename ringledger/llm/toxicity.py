"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; all text of the learning fold, whatever it is, is unlabelled. The risk of a linear model
is pi E+[l(f)] + max(0, Eu[l(-f)] - pi E+[l(-f)]), with the logistic loss l and pi the share of toxic documents; where the second term falls below
zero, the step goes against it, so the model cannot win by calling positives' likeness negative. Features are whether a word
or the beginning of a word occurs, and whether a beginning occurs in two words, kept where it is clearly commoner among positives than among the unlabelled; the others
would leave noise that adds up in long clean documents.

The model is fitted in numpy on a bounded sample (`POSITIVES`, `UNLABELLED`, by the hash of the id) and scores all documents
in one pass without a shuffle.
"""

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringledger.llm.common import Adam, agreed_labels, bounded_batches, first_by_hash, logistic, one_of_each_id, sigmoid

POSITIVES = 2_000
UNLABELLED = 4_000
THRESHOLD = 0.3
STEPS = 500
#: A telling feature is in so many positives, whatever their number, and so many deviations commoner among them.
MIN_DOCUMENTS = 3
APART, PURITY = 5.0, 0.3
L2 = 1e-4
PREFIXES = (4, 5, 6)
SKETCH = 6
_ORDERS = (1, 0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)
#: What a worker keeps of words met before; longer ones are looked at each time.
KEPT_WORDS, KEPT_WORD_CHARS = 300_000, 64
_WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[int]:
    """Hashes of the word and of its beginnings that are shorter than it."""
    return [crc32(word.encode()), *[crc32(f"{word[:n]}*".encode()) for n in PREFIXES if len(word) >= n]]


def twice(feature: int) -> int:
    """The feature of a beginning that two or more different words of a document have."""
    return feature ^ 0x5BD1E995


def document_features(text: str | None) -> list[int]:
    found: dict[int, int] = {}
    for word in words_of(text):
        for f in word_features(word):
            found[f] = found.get(f, 0) + 1
    return sorted({*found, *[twice(f) for f, times in found.items() if times > 1]})


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


class Model:
    """Weights by feature; those not held are zero."""

    def __init__(self, weights: dict[int, float], bias: float):
        self.weights, self.bias = weights, bias

    def __getstate__(self):
        return {"weights": self.weights, "bias": self.bias}

    def scores(self, texts: list[str | None], known: dict[str, tuple]) -> np.ndarray:
        out, weights = np.full(len(texts), self.bias), self.weights
        for i, text in enumerate(texts):
            found: dict[int, int] = {}
            for word in words_of(text):
                active = known.get(word)
                if active is None:
                    active = tuple(f for f in word_features(word) if f in weights or twice(f) in weights)
                    if len(known) > KEPT_WORDS:
                        known.clear()
                    if len(word) <= KEPT_WORD_CHARS:
                        known[word] = active
                for f in active:
                    found[f] = found.get(f, 0) + 1
            for f in sorted(found):
                out[i] += weights.get(f, 0.0) + (weights.get(twice(f), 0.0) if found[f] > 1 else 0.0)
        return sigmoid(out)


def telling(positive: np.ndarray, unlabelled: np.ndarray, n: int, m: int, prior: float) -> np.ndarray:
    """Whether a feature held by so many of n positives and m unlabelled documents is clearly commoner among positives.

    At weight zero the slope of the risk by a feature's weight is proportional to this difference of shares; by the prior
    they also tell which part of the documents with the feature is positive.
    """
    p, u = positive / n, unlabelled / max(1, m)
    noise = np.sqrt((u + 1 / (m + 1)) * (1 / n + 1 / max(1, m)))
    return (positive >= MIN_DOCUMENTS) & (p - u > APART * noise) & (prior * p > PURITY * u)


def _columns(documents: list[np.ndarray], names: np.ndarray) -> list[np.ndarray]:
    """For each document the places of its features in `names`, those that are there."""
    flat = np.concatenate(documents) if documents else np.zeros(0, np.uint32)
    at = np.minimum(np.searchsorted(names, flat), max(0, len(names) - 1))
    there = names[at] == flat if len(names) else np.zeros(len(flat), bool)
    ends = np.cumsum([len(d) for d in documents])
    return [c[t] for c, t in zip(np.split(at, ends[:-1]), np.split(there, ends[:-1]), strict=True)]


def _once(documents: list[np.ndarray]) -> list[np.ndarray]:
    """Without copies and near copies, which would make a chance word of one text look like a rule.

    Texts are near copies here if the smallest features agree under one of a few orders.
    """
    seen: set[tuple] = set()
    out = []
    for d in sorted(documents, key=lambda d: (len(d), d.tobytes())):
        keys = [(k, np.sort(d * np.uint32(factor))[:SKETCH].tobytes()) for k, factor in enumerate(_ORDERS)]
        if not seen.intersection(keys):
            out.append(d)
        seen.update(keys)
    return out


def fit_weights(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Model:
    """The model of least non-negative risk; each document is an array of distinct feature hashes."""
    positive, unlabelled = _once(positive), _once(unlabelled)
    n, m = len(positive), len(unlabelled)
    names, counts = np.unique(np.concatenate(positive), return_counts=True)
    names, counts = names[counts >= MIN_DOCUMENTS], counts[counts >= MIN_DOCUMENTS]
    columns = _columns([*positive, *unlabelled], names)
    among = np.bincount(np.concatenate([names[:0].astype(np.int64), *columns[n:]]), minlength=len(names))
    kept = telling(counts, among, n, m, prior)
    place = np.cumsum(kept) - 1
    columns = [place[c[kept[c]]] for c in columns]
    # the slope at zero tells how to begin: log odds of the shares
    weights = np.log(((counts + 0.5) / (n + 1) / ((among + 0.5) / (m + 1)))[kept]) / 4  # a word and its beginnings come together
    names, bias = names[kept], float(np.log(prior / (1 - prior)) - 1)
    column, row = np.concatenate(columns), np.repeat(np.arange(n + m), [len(c) for c in columns])
    is_positive = np.arange(n + m) < n
    steps, bias_steps = Adam(0.05), Adam(0.05)
    for _ in range(STEPS):
        f = bias + np.bincount(row, weights=weights[column], minlength=n + m)
        p = sigmoid(f)
        rest = (logistic(f[n:]).mean() if m else 0.0) - prior * logistic(f[:n]).mean()
        # derivatives by f: of the positives' risk, and of the estimate of the negatives' risk
        toward = np.where(is_positive, prior * (p - 1) / n, 0.0)
        negative = np.where(is_positive, -prior * p / n, p / max(1, m))
        by_f = toward + negative if rest >= 0 else -negative
        weights = weights - steps.step(np.bincount(column, weights=by_f[row], minlength=len(names)) + L2 * weights)
        bias -= float(bias_steps.step(np.array([by_f.sum()]))[0])
    return Model({int(k): float(w) for k, w in zip(names, weights, strict=True)}, bias)


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    learn_labels: Column,
    learn_docs: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    prior: float | None = None,
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
) -> Model:
    """The model fitted on at most `positives` toxic documents and `unlabelled` ones of all.

    Only label rows for which `learn_labels` holds, and documents for which `learn_docs` holds, teach. `prior` is the share
    of toxic documents; by default it is estimated as that among the labels that teach. Ids with contradicting or null
    labels count as unlabelled. Without toxic documents the model is even and low: every score is 0.01.
    """
    bounded_batches(docs.sparkSession)
    known = agreed_labels(labels.where(learn_labels), id_col, label_col)
    toxic, all_ = known.agg(F.sum("label"), F.count("*")).first()
    if not toxic:
        return Model({}, float(np.log(0.01 / 0.99)))
    prior = min(0.5, max(0.005, toxic / all_)) if prior is None else prior
    confirmed = known.where("label = 1").select("id")
    # the unlabelled ones stand for all documents, so confirmed ones may be among them
    others = docs.where(learn_docs).select(F.col(id_col).alias("id")).where("id is not null").distinct()
    chosen = first_by_hash(confirmed, positives).withColumn("label", F.lit(1))
    chosen = chosen.unionByName(first_by_hash(others, unlabelled).withColumn("label", F.lit(0)))

    @F.pandas_udf("binary")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([np.array(document_features(t), np.uint32).tobytes() for t in texts], dtype=object)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    rows = one_of_each_id(rows, "id", "label")  # no more than the sample's rows reach the driver
    got = rows.select("id", "label", features("text").alias("x")).toPandas().sort_values(["id", "x"])
    split = {k: [np.frombuffer(x, np.uint32) for x in got.loc[got["label"] == k, "x"]] for k in (0, 1)}
    if not split[1]:
        return Model({}, float(np.log(0.01 / 0.99)))
    return fit_weights(split[1], split[0], prior)


def toxicity_score(model: Model):
    """A function of a text column: toxicity from 0 to 1."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, tuple] = {}
        for texts in batches:
            yield pd.Series(model.scores(texts.tolist(), known))

    return score


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of each row's whole text; `predicted` is 1 from a score of 0.3 on.

    Null and empty texts score as texts without words. Ids may be null or repeated; other columns are ignored; an empty
    table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    scored = docs.select(F.col(id_col).alias("doc_id"), toxicity_score(model)(F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))

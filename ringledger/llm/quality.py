"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features are measures of the line and of its neighbours; transitions tie neighbouring labels.
Forward-backward gives each line's marginal, and the document's quality is their mean weighted by line length, put on a
probability scale by a logistic fit.

The field is fitted in numpy on a bounded sample of labelled documents (`SAMPLE` of each label, chosen by the hash of the
id), whose lines all carry the document's label. Scoring streams over all documents without a shuffle.
"""

from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringledger.llm.common import (
    Adam,
    agreed_labels,
    blocks_of_texts,
    bounded_batches,
    first_by_hash,
    lent,
    logistic,
    one_of_each_id,
    sigmoid,
)

SAMPLE = 1_200
THRESHOLD = 0.3
STEPS = 120

# Characters counted per class.
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGITS = b"0123456789"
_STOPS = b".,;:'-"
_SYMBOLS = b"!\"#$%&()*+/<=>?@[\\]^_`{|}~"
_BLANKS = b" \t\r\x0b\x0c"
_CLASSES = (_UPPER, _DIGITS, _STOPS, _SYMBOLS, _BLANKS, bytes(range(128, 256)))


def line_measures(line: str, seen: bool) -> list[float]:
    data = line.encode()
    n = len(data) or 1
    words = line.split()
    k = len(words) or 1
    return [
        np.log1p(len(data)),
        np.log1p(len(words)),
        len(data) / k,
        *[(len(data) - len(data.translate(None, chars))) / n for chars in _CLASSES],
        len(set(words)) / k,
        sum(map(eq, words, words[1:])) / k,
        len(set(data)) / min(n, 64),
        float(seen),
        float(line[:1].isupper()),
        float(line.rstrip()[-1:] in (".", "!", "?")),
    ]


MEASURES = len(line_measures("", False))


def measured(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(measures of all lines, lines per text, bytes per line, 1 at least); a null or empty text is one empty line."""
    rows, lines, sizes = [], [], []
    for text in texts:
        seen: set[str] = set()
        parts = (text or "").split("\n")
        for line in parts:
            rows.append(line_measures(line, line in seen))
            seen.add(line)
            sizes.append(max(1, len(line)))
        lines.append(len(parts))
    return np.array(rows).reshape(-1, MEASURES), np.array(lines, np.int64), np.array(sizes, float)


class Chains:
    """The order in which the lines of many documents are visited: all first lines, all second lines, and so on."""

    def __init__(self, lines: np.ndarray):
        self.starts = np.cumsum(lines) - lines
        order = np.argsort(-lines, kind="stable")
        lengths = lines[order]
        longest = int(lengths[0]) if len(lengths) else 0
        # documents with more than t lines come first
        active = np.searchsorted(-lengths, -np.arange(1, longest + 1), side="right")
        self.steps = [self.starts[order[:m]] + t for t, m in enumerate(active.tolist())]
        self.after = [self.starts[order[:m]] + t for t, m in enumerate([*active.tolist()[1:], 0])]
        self.lines = lines

    def marginals(self, unary: np.ndarray, tie: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log odds of good against bad: of what comes before a line and itself, of what comes after, of both."""
        before, after = unary.copy(), np.zeros_like(unary)
        for step in self.steps[1:]:
            a = before[step - 1]
            before[step] += np.logaddexp(a + tie[1, 1], tie[0, 1]) - np.logaddexp(a + tie[1, 0], tie[0, 0])
        for step in reversed(self.after):
            if len(step):
                b = unary[step + 1] + after[step + 1]
                after[step] = np.logaddexp(tie[1, 1] + b, tie[1, 0]) - np.logaddexp(tie[0, 1] + b, tie[0, 0])
        return before, after, before + after


def with_neighbours(x: np.ndarray, chains: Chains) -> np.ndarray:
    """The line's features, those of the line before and of the line after (zero at the ends), and a constant."""
    first = np.zeros(len(x), bool)
    first[chains.starts] = True
    last = np.zeros(len(x), bool)
    last[chains.starts + chains.lines - 1] = True
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    before[first], after[last] = 0, 0
    return np.concatenate([x, before, after, first[:, None], last[:, None], np.ones((len(x), 1))], axis=1)


class Field:
    """The fitted field; `scores` gives the quality of whole texts."""

    def __init__(self):
        self.mean, self.scale = np.zeros(MEASURES), np.ones(MEASURES)
        self.weights, self.tie = np.zeros(6 * MEASURES + 3), np.zeros((2, 2))
        self.slope, self.shift = 1.0, 0.0

    def features(self, measures: np.ndarray, chains: Chains) -> np.ndarray:
        z = np.clip((measures - self.mean) / self.scale, -4, 4)
        return with_neighbours(np.concatenate([z, z**2 / 4], axis=1), chains)

    def fit(self, measures: np.ndarray, lines: np.ndarray, sizes: np.ndarray, good: np.ndarray) -> "Field":
        self.mean, self.scale = measures.mean(axis=0), measures.std(axis=0) + 1e-6
        chains = Chains(lines)
        x, y = self.features(measures, chains), np.repeat(good, lines).astype(float)
        second = np.concatenate(chains.after) if len(lines) else np.zeros(0, int)  # lines that have a next one
        # every document counts the same, and both labels do
        share = np.where(good == 1, 0.5 / max(1, good.sum()), 0.5 / max(1, (1 - good).sum()))
        per_line = np.repeat(share / lines, lines)
        steps, tie_steps = Adam(0.05), Adam(0.02)
        for _ in range(STEPS):
            before, after, odds = chains.marginals(x @ self.weights, self.tie)
            gradient = x.T @ ((sigmoid(odds) - y) * per_line) + 1e-4 * self.weights
            follow = (x[second + 1] @ self.weights) + after[second + 1]
            joint = np.stack(
                [self.tie[i, j] + i * before[second] + j * follow for i in (0, 1) for j in (0, 1)]
            )
            joint = np.exp(joint - joint.max(axis=0))
            joint /= joint.sum(axis=0)
            seen = np.stack([(y[second] == i) & (y[second + 1] == j) for i in (0, 1) for j in (0, 1)])
            tie = ((joint - seen) * per_line[second]).sum(axis=1).reshape(2, 2) + 0.02 * self.tie
            self.weights -= steps.step(gradient)
            self.tie -= tie_steps.step(tie)
        quality = self.odds_of(*self.quality(measures, lines, sizes))
        calibrate = Adam(0.05)
        for _ in range(300):
            error = (sigmoid(self.slope * quality + self.shift) - good) * share
            change = calibrate.step(np.array([(error * quality).sum(), error.sum()]))
            self.slope, self.shift = self.slope - change[0], self.shift - change[1]
        return self

    def quality(self, measures, lines, sizes) -> tuple[np.ndarray, np.ndarray]:
        """Sums, over the lines of each document, of length times marginal and of lengths."""
        chains = Chains(lines)
        odds = chains.marginals(self.features(measures, chains) @ self.weights, self.tie)[2]
        return np.add.reduceat(sizes * sigmoid(odds), chains.starts), np.add.reduceat(sizes, chains.starts)

    @staticmethod
    def odds_of(good: np.ndarray, all_: np.ndarray) -> np.ndarray:
        q = np.clip(good / all_, 1e-4, 1 - 1e-4)
        return np.log(q) - np.log1p(-q)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros(len(texts))
        for a, b in blocks_of_texts(texts, 1 << 18):
            odds = self.odds_of(*self.quality(*measured(texts[a:b])))
            out[a:b] = sigmoid(self.slope * odds + self.shift)
        return out


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
) -> Field:
    """The field fitted on at most `sample` documents of each label among the label rows for which `learn` holds.

    Ids with contradicting or null labels teach nothing. Without a document of each label the field is even: every score
    is 0.5.
    """
    bounded_batches(docs.sparkSession)
    known = agreed_labels(labels.where(learn), id_col, label_col)
    chosen = first_by_hash(known.where("label = 0"), sample).unionByName(first_by_hash(known.where("label = 1"), sample))

    @F.pandas_udf("struct<measures:binary,sizes:binary>")
    def lines_of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in lent(batches):
            done = [measured([t]) for t in texts]
            yield pd.DataFrame(
                {"measures": [m.astype(np.float32).tobytes() for m, _, _ in done], "sizes": [s.tobytes() for _, _, s in done]},
                dtype=object,
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    # a document counts once, and no more than the sample's rows reach the driver, however often an id is there
    rows = one_of_each_id(rows, "id", "label")
    got = rows.select("id", "label", lines_of("text").alias("x")).select("id", "label", "x.*").toPandas()
    got = got.sort_values(["id", "sizes"], ignore_index=True)
    if got["label"].nunique() < 2:
        return Field()
    measures = np.concatenate([np.frombuffer(m, np.float32).reshape(-1, MEASURES) for m in got["measures"]]).astype(float)
    sizes = [np.frombuffer(s) for s in got["sizes"]]
    return Field().fit(
        measures, np.array([len(s) for s in sizes]), np.concatenate(sizes), got["label"].to_numpy(np.int64)
    )


def quality_score(field: Field):
    """A function of a text column: quality from 0 to 1."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in lent(batches):
            yield pd.Series(field.scores(texts.tolist()))

    return score


def line_labels(field: Field):
    """A function of a text column: for each line the probability that it is good."""

    @F.pandas_udf("array<double>")
    def marginals(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = []
            for text in texts:
                measures, lines, _ = measured([text])
                chains = Chains(lines)
                out.append(sigmoid(chains.marginals(field.features(measures, chains) @ field.weights, field.tie)[2]))
            yield pd.Series(out)

    return marginals


def score_documents(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of each row's whole text; `predicted` is 1 from a score of 0.3 on.

    Null and empty texts are scored as one empty line. Ids may be null or repeated; other columns are ignored; an empty
    table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    scored = docs.select(F.col(id_col).alias("doc_id"), quality_score(field)(F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))

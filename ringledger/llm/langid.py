"""Language identification by error-correcting output codes.

Each language has a codeword. One binary classifier per bit, logistic regression on hashed byte n-grams, predicts that bit
of the codeword. Decoding adds up, for each language, the logistic losses of all bits against its codeword, each weighted by
how well that bit's classifier does; the language of least loss is nearest, and a text whose second language is nearly as
near is flagged as ambiguous.

With few languages the code has every split of them into two sides; with more, codewords are random and the best of
several draws by least distance. Classifiers are fitted in numpy on at most `SAMPLE` documents a language, chosen by the
hash of the id; scoring streams over all documents.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringledger.llm.common import Adam, bounded_batches, logistic, one_of_each_id, sigmoid

SAMPLE = 250
DIMENSIONS = 1 << 13
STEPS = 150
MARGIN = 0.1
UNKNOWN = "und"
#: ASCII without letters becomes a blank, so that runs of marks and digits say nothing.
_TABLE = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))


def features(text: str) -> np.ndarray:
    """Root frequencies of hashed byte 2- and 3-grams of the lower-cased text, of length one."""
    data = np.frombuffer(f" {text.lower()} ".encode().translate(_TABLE), np.uint8).astype(np.uint32)
    shift = np.uint32(32 - DIMENSIONS.bit_length() + 1)
    two = data[:-1] << np.uint32(8) | data[1:]
    three = two[:-1] << np.uint32(8) | data[2:]
    counts = np.bincount((two * np.uint32(2246822519)) >> shift, minlength=DIMENSIONS)
    counts += np.bincount((three * np.uint32(2654435761) + np.uint32(374761393)) >> shift, minlength=DIMENSIONS)
    x = np.sqrt(counts, dtype=np.float32)
    return x / np.float32(np.sqrt(max(1, counts.sum())))


def codewords(languages: int) -> np.ndarray:
    """A row of -1 and 1 per language, a column per bit; rows differ in as many bits as can be."""
    if languages <= 2:
        return np.array([[-1.0], [1.0]])[:languages]
    if languages <= 6:  # every split into two sides once
        bits = [[1.0 if (s >> i) & 1 else -1.0 for i in range(languages)] for s in range(1, 1 << (languages - 1))]
        return np.array(bits).T
    rng = np.random.default_rng(languages)
    size = 12 * (languages - 1).bit_length()
    best, most = None, -1
    for _ in range(64):
        code = rng.choice([-1.0, 1.0], (languages, size))
        apart = (size - code @ code.T) / 2
        least = apart[~np.eye(languages, dtype=bool)].min()
        if least > most and (np.abs(code.sum(axis=0)) < languages).all():
            best, most = code, least
    return best


class Languages:
    """The fitted classifiers with their codewords."""

    def __init__(self, names: list[str], x: np.ndarray, y: np.ndarray):
        self.names, self.code = names, codewords(len(names))
        target = self.code[y].astype(np.float32)
        self.weights = np.zeros((DIMENSIONS, self.code.shape[1]), np.float32)
        self.bias = np.zeros(self.code.shape[1], np.float32)
        steps, bias_steps = Adam(0.3), Adam(0.05)
        share = 1.0 / np.bincount(y, minlength=len(names))[y] / max(1, len(names))  # languages count the same
        for _ in range(STEPS):
            margin = target * (x @ self.weights + self.bias)
            slope = (-target * sigmoid(-margin) * share[:, None]).astype(np.float32)
            self.weights -= steps.step(x.T @ slope + np.float32(1e-6) * self.weights).astype(np.float32)
            self.bias -= bias_steps.step(slope.sum(axis=0)).astype(np.float32)
        loss = (logistic(-target * (x @ self.weights + self.bias)) * share[:, None]).sum(axis=0)
        self.trust = (1.0 / (0.02 + loss)).astype(np.float64)
        self.trust /= self.trust.sum()

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        out = []
        for text in texts:
            if not text or not any(map(str.isalpha, text)):
                out.append((UNKNOWN, 0.0, True))
            elif len(self.names) == 1:
                out.append((self.names[0], 1.0, False))
            else:
                f = features(text) @ self.weights + self.bias
                loss = logistic(-self.code * f) @ self.trust
                odds = np.exp(-(loss - loss.min()) * len(self.trust))
                odds /= odds.sum()
                best = int(np.argmin(loss))
                second = np.partition(loss, 1)[1]
                out.append((self.names[best], float(odds[best]), bool(second - loss[best] < MARGIN)))
        return out


def fit_languages(
    docs: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = SAMPLE,
) -> Languages | None:
    """Classifiers fitted on at most `sample` documents of each language among the rows for which `learn` holds; None if
    no row with a text, an id and a language is there."""
    bounded_batches(docs.sparkSession)
    rows = docs.where(learn).select(
        F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")
    )
    rows = rows.where("id is not null and lang is not null and text is not null and text <> ''")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = rows.select("id", "lang").withColumn("place", F.row_number().over(order)).where(f"place <= {sample}")

    @F.pandas_udf("binary")
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([features(t).astype(np.float16).tobytes() for t in texts], dtype=object)

    chosen = F.broadcast(chosen.select("id", "lang").distinct())  # `sample` rows a language
    got = one_of_each_id(rows.join(chosen, ["id", "lang"]), "id", "lang").select("id", "lang", measured("text").alias("x")).toPandas()
    if got.empty:
        return None
    got = got.sort_values(["lang", "id", "x"])
    names = sorted(got["lang"].unique())
    x = np.stack([np.frombuffer(v, np.float16) for v in got["x"]]).astype(np.float32)
    return Languages(names, x, np.searchsorted(names, got["lang"].to_numpy()))


def identify(
    docs: DataFrame, languages: Languages | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous) of each row's whole text.

    A null text, or one without a letter, is `und` with score 0 and ambiguous, as is every text if there was nothing to
    learn from. Ids may be null or repeated; other columns are ignored; an empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("struct<lang_pred:string,score:double,ambiguous:boolean>")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            none = [(UNKNOWN, 0.0, True)] * len(texts)
            rows = languages.predict(texts.tolist()) if languages else none
            yield pd.DataFrame(rows, columns=["lang_pred", "score", "ambiguous"])

    found = docs.select(F.col(id_col).alias("doc_id"), predicted(F.col(text_col)).alias("p"))
    return found.select("doc_id", "p.*")

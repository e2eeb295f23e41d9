"""What the text operators share: folds, label tables, Arrow batches of bounded size, stored tables."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringledger.session import shared_folder

#: ASCII white space, as in the class [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
ROWS_PER_BATCH = 1_000
BYTES_PER_BATCH = 16 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for whole long texts: at most 1,000 rows and about 16 MB each.

    The settings are lowered, never raised; results do not depend on them.
    """
    for key, most in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH),
        ("spark.sql.execution.arrow.maxBytesPerBatch", BYTES_PER_BATCH),
    ):
        now = spark.conf.get(key, None)
        if now is None or not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def lent(batches: Iterator) -> Iterator:
    """The batches of a worker, in memory of the system's own allocator: workers stay for later stages, and Arrow's default pool
    would keep the most that any batch took."""
    pa.set_memory_pool(pa.system_memory_pool())
    yield from batches


def remainder(id_col: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo `divisor`; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % divisor


def held_out(id_col: str, divisor: int, kept: int) -> Column:
    """Whether a row belongs to the fold nothing is learned from; a row without id does not."""
    return F.coalesce(remainder(id_col, divisor) == kept, F.lit(False))


def agreed_labels(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(id, label 0/1) of the ids whose rows all say the same; null ids and labels are left out."""
    return (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .where("id is not null and label in (0, 1)")
        .groupBy("id")
        .agg(F.min("label").alias("label"), F.max("label").alias("most"))
        .where("label = most")
        .drop("most")
    )


def first_by_hash(ids: DataFrame, bound: int) -> DataFrame:
    """At most `bound` rows, chosen by the hash of `id` alone, so that the choice is the same on every run."""
    return ids.orderBy(F.xxhash64("id"), "id").limit(bound)


def one_of_each_id(rows: DataFrame, *keys: str) -> DataFrame:
    """One row for each value of the keys, that with the smallest hash of `text`; reduced in each task before the shuffle."""
    return rows.groupBy(*keys).agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened where a column of `df` has one of them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def whole_row(df: DataFrame) -> Column:
    """All columns in one struct, whatever their names."""
    return F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns])


def stored(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read again: cuts the lineage and survives lost executors."""
    path = shared_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def blocks_of_texts(texts, most_bytes: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about `most_bytes` characters together; a longer text is a range of its own."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if i > start and size + n > most_bytes:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def logistic(x: np.ndarray) -> np.ndarray:
    """log(1 + exp(x)) without overflow."""
    return np.logaddexp(0.0, x)


class Adam:
    """Step sizes per weight for full-batch gradients."""

    def __init__(self, rate: float):
        self.rate, self.steps, self.first, self.second = rate, 0, 0.0, 0.0

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.steps += 1
        self.first = 0.9 * self.first + 0.1 * gradient
        self.second = 0.999 * self.second + 0.001 * gradient**2
        mean = self.first / (1 - 0.9**self.steps)
        return self.rate * mean / (np.sqrt(self.second / (1 - 0.999**self.steps)) + 1e-8)

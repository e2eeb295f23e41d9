"""A training-corpus pipeline of five operators: quality, repeated lines, near duplicates, benchmark items, tokens."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringledger.llm import bpe, decontam, line_dedup, quality, simhash
from ringledger.llm.common import bounded_batches, remainder, stored
from ringledger.llm.queries import WORD_BPE, encoded_digests, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.3."""
    bounded_batches(spark)
    field = quality.fit_quality(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0)
    return docs.where(quality.quality_score(field)("text") >= quality.THRESHOLD)


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a smaller id has; `n_chars` follows the text."""
    kept = line_dedup.dedup_lines(docs)
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near duplicates."""
    return simhash.one_of_each(docs).select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text."""
    return encoded_digests(bpe.encode_documents(docs, WORD_BPE))


STAGES = [
    ("quality", good_documents),
    ("line_dedup", without_shared_lines),
    ("simhash", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("bpe", encoded),
]

#: The classifier, the fingerprints and the tokenizer have no SQL; tests run the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage's rows are a table in the shared folder that the next one reads."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir))
    return docs

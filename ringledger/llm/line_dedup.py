"""Line dedup with DataFrame functions only.

Explode normalised lines, hash them, find the keys of more than one document, and reassemble what is left by position.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringledger.llm.common import BLANKS, stored, unused

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased and all other characters as they are."""
    stripped = F.btrim(line, F.lit(BLANKS))
    # lower() also folds other alphabets; on pure ASCII it is the same as the slower translate()
    return F.when(F.octet_length(stripped) == F.char_length(stripped), F.lower(stripped)).otherwise(
        F.translate(stripped, UPPER, LOWER)
    )


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("version"), text.alias("text"))


def _keys(lines: DataFrame, min_chars: int) -> DataFrame:
    """(id, version, pos, h1, h2) of each line long enough; two hashes with chained seeds make 128 bits."""
    first = F.xxhash64("key")
    return (
        lines.where("id is not null")
        .select("id", "version", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
        .select("id", "version", "pos", line_key(F.col("line")).alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select("id", "version", "pos", first.alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2"))
    )


def dropped_positions(docs: DataFrame, id_col: str, text_col: str, min_chars: int = 10, threshold: int = 2) -> DataFrame:
    """(id, version, dropped): the line numbers each text loses, null ids and untouched texts left out."""
    keys = _keys(_lines(docs, id_col, text_col), min_chars)
    if threshold == 2:  # smallest and largest id differ; both aggregate before the shuffle without distinct rows
        holders = keys.groupBy("h1", "h2").agg(F.min("id").alias("keeper"), F.max("id").alias("last"))
        shared = holders.where("keeper < last").drop("last")
    else:
        holders = keys.select("id", "h1", "h2").distinct().groupBy("h1", "h2")
        shared = holders.agg(F.min("id").alias("keeper"), F.count("*").alias("n")).where(F.col("n") >= threshold).drop("n")
    # stored before the join: with nothing but an exchange on either side, Spark splits the rows of a very common line
    shared = stored(docs.sparkSession, shared)
    return (
        keys.join(shared, ["h1", "h2"])
        .where("id > keeper")
        .groupBy("id", "version")
        .agg(F.collect_set("pos").alias("dropped"))
    )


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 10,
    threshold: int = 2,
) -> DataFrame:
    """All columns of `docs`, with the text reduced to the lines that stay, and `n_lines` and `n_dropped` added.

    A key (see `line_key`) of at least `min_chars` code points that `threshold` or more documents hold loses its lines
    in all of them but the smallest id. A null or empty text is one empty line and comes back as an empty text. Rows
    with one id are one document: repeats of a row lose the same lines, and different texts under one id do not make a
    line shared. A row with a null id keeps its whole text and counts for no key. Columns of `docs` other than the two
    named ones pass through; an existing `n_lines` or `n_dropped` is replaced. An empty table gives an empty table.

    Only hashes and line numbers are aggregated; the texts move once, by id. A key that a third of all lines holds is
    reduced before the shuffle to one row a task, and Spark splits its part of the join.
    """
    of, version, dropped, parts, stay = unused(docs, "__id", "__version", "__dropped", "__lines", "__kept")
    gone = dropped_positions(docs, id_col, text_col, min_chars, threshold).select(
        F.col("id").alias(of), F.col("version").alias(version), F.col("dropped").alias(dropped)
    )
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.withColumn(text_col, text)
    joined = rows.join(gone, (rows[id_col] == gone[of]) & (F.xxhash64(rows[text_col]) == gone[version]), "left")
    lines = F.split(F.col(text_col), "\n")
    size = F.size(parts)
    # array_except keeps the order and hashes the dropped numbers, so a text of very many lines stays linear
    kept = F.array_except(F.sequence(F.lit(0), size - 1), F.coalesce(F.col(dropped), F.array().cast("array<int>")))
    return (
        joined.withColumn(parts, lines)
        .withColumn(stay, kept)
        .withColumn("n_lines", size.cast("long"))
        .withColumn("n_dropped", (size - F.size(stay)).cast("long"))
        .withColumn(
            text_col,
            F.when(F.col(dropped).isNull(), F.col(text_col)).otherwise(
                F.array_join(F.transform(stay, lambda i: F.col(parts)[i]), "\n")
            ),
        )
        .drop(of, version, dropped, parts, stay)
    )

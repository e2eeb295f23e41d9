"""What each run stored, in one line per slice, so that a bookmark opens one small file and not the history.

The line of a run is written behind its slice: a run that was killed in between has no line, its bookmark is the one before
it, and a repeat of the run writes both again. Runs with and without rows are in two folders, so that the newest run with rows
is found by names alone.
"""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringledger.sources import files
from ringledger.sources.versions import names_in, remove, write_text

RUNS = "_runs"
LINE = T.StructType(
    [T.StructField("rows", T.LongType()), T.StructField("last", T.StringType()), T.StructField("place", T.StringType())]
)
_FILLED, _EMPTY = f"{RUNS}/filled", f"{RUNS}/empty"


def write_run(df: DataFrame, path: str, run: str, value: str | None = None, place: list[str] | None = None) -> int:
    """Store the rows of a run in place of what it stored before, with their line; gives the number of rows.

    The line holds the `value` of the last row, in the order of the columns `place`, and that place as text.
    """
    spark = df.sparkSession
    files.write_slice(df, path, run)
    stored = spark.read.schema(df.schema).parquet(f"{path}/run={run}")
    none = F.lit(None).cast("string")
    at = F.struct(*place) if place else None
    last = F.max_by(F.col(value).cast("string"), at) if value and place else none
    top = F.max(at).cast("string") if place else none
    line = stored.agg(F.count(F.lit(1)).alias("rows"), last.alias("last"), top.alias("place")).first()
    kind, other = (_FILLED, _EMPTY) if line["rows"] else (_EMPTY, _FILLED)
    write_text(spark, f"{path}/{kind}/run={run}.json", json.dumps(line.asDict(), ensure_ascii=False))
    remove(spark, f"{path}/{other}/run={run}.json")
    return line["rows"]


def has_lines(spark: SparkSession, path: str) -> bool:
    return files.exists(spark, f"{path}/{RUNS}")


def newest_run(spark: SparkSession, path: str, upto: str | None = None, before: str | None = None) -> str | None:
    """The newest run that has rows, up to or before a given one. Names of folders are listed, nothing is opened."""
    files_ = [n for n in names_in(spark, f"{path}/{_FILLED}") if n.startswith("run=") and n.endswith(".json")]
    runs = sorted(n.removeprefix("run=").removesuffix(".json") for n in files_)
    runs = [r for r in runs if (upto is None or r <= upto) and (before is None or r < before)]
    return runs[-1] if runs else None


def line_of(spark: SparkSession, path: str, run: str) -> DataFrame:
    """(rows, last, place) of a run with rows."""
    return spark.read.schema(LINE).json(f"{path}/{_FILLED}/run={run}.json")


def last_of(spark: SparkSession, path: str, upto: str | None = None, before: str | None = None) -> DataFrame:
    """One row with the column `last`: the value of the last row of the newest run that has rows; NULL if there is none."""
    run = newest_run(spark, path, upto, before)
    if run is None:
        return spark.range(1).select(F.lit(None).cast("string").alias("last"))
    return line_of(spark, path, run).select("last")

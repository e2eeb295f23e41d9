"""Tables that are replaced as a whole, so that readers never meet a half-written one.

A refresh writes a version of its own below `path/_versions` and commits it by creating an empty file of the version's name
below `path/_commits`, which a file system or object store does in one step. Readers take the version of the greatest commit.
What is there stays until the new version is whole; the version before it stays for readers that have begun on it, and a
refresh that was killed leaves a version without a commit, which nobody reads and the next refresh removes.
"""

import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

VERSIONS, COMMITS = "_versions", "_commits"
KEPT = 2


def _place(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """File system and path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder, none if it is not there."""
    fs, place = _place(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, place = _place(spark, path)
    fs.delete(place, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A file of one short text, in place of what is there."""
    fs, place = _place(spark, path)
    out = fs.create(place, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _number(name: str) -> int:
    return int(name.split("-")[0])


def current(spark: SparkSession, path: str) -> str | None:
    """Path of the version that readers see, None before the first commit."""
    commits = names_in(spark, f"{path}/{COMMITS}")
    return f"{path}/{VERSIONS}/{commits[-1]}" if commits else None


def read_current(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The table as it was last committed; a folder without commits is read as it is."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(current(spark, path) or path)


def refresh(df: DataFrame, path: str) -> None:
    """Replace the table. An error on the way leaves the one before it; of two refreshes at a time the later commit wins."""
    spark = df.sparkSession
    before = names_in(spark, f"{path}/{COMMITS}")
    number = _number(before[-1]) + 1 if before else 1
    name = f"{number:012d}-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{VERSIONS}/{name}")
    write_text(spark, f"{path}/{COMMITS}/{name}", "")
    _tidy(spark, path, number)


def _tidy(spark: SparkSession, path: str, number: int) -> None:
    """Remove versions that a newer commit but one has replaced, and what refreshes before this one left unfinished."""
    commits = names_in(spark, f"{path}/{COMMITS}")
    for name in commits[:-KEPT]:
        remove(spark, f"{path}/{COMMITS}/{name}")
    for name in names_in(spark, f"{path}/{VERSIONS}"):
        # a version of this number or a higher one without a commit may be one that is being written
        if name not in commits[-KEPT:] and (name in commits or _number(name) < number):
            remove(spark, f"{path}/{VERSIONS}/{name}")

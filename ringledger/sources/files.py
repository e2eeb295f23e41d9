"""Raw and warehouse tables as files, run state and run audit.

A raw table is a folder with one `run=<id>` slice per run. A run that is repeated overwrites its own slice, so a
retry neither loses nor doubles rows.
"""

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringledger.schemas import AUDIT, STATE
from ringledger.session import shared_folder
from ringledger.values import EVENT_DATE_FORMAT


CORRUPT = "_corrupt"


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, long_dates: bool = False, line_breaks: bool = False
) -> DataFrame:
    """Typed scan of CSV with a header. Timestamps use the default ISO form; quotes inside a cell are doubled.

    `long_dates` reads dates written like "March 11, 1994". `line_breaks` allows them inside quoted cells; a file is then
    read by one task. A row that does not fit the schema is kept, with NULL for what cannot be read; `csv_rejects` lists
    these rows.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", line_breaks).schema(schema)
    if long_dates:
        reader = reader.option("dateFormat", EVENT_DATE_FORMAT)
    return reader.option("columnNameOfCorruptRecord", CORRUPT).csv(path)


def csv_rejects(
    spark: SparkSession, path: str, schema: T.StructType, long_dates: bool = False, line_breaks: bool = False
) -> DataFrame:
    """Text of the CSV rows with too few or too many cells, or with a cell that is not of its column's type."""
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = read_csv(spark, path, wide, long_dates, line_breaks)
    # whether a row fits is only known when all its columns are read, so these few rows are stored first
    place = shared_folder(spark)
    rows.filter(F.col(CORRUPT).isNotNull()).write.parquet(place)
    return spark.read.schema(wide).parquet(place).select(F.col(CORRUPT).alias("row"))


def write_csv(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists on its file system; errors other than a missing path are raised."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at `path`, empty if nothing has been written yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def write_slice(df: DataFrame, path: str, run: str) -> None:
    """Store the rows of one run, replacing what the same run stored before."""
    df.write.mode("overwrite").parquet(f"{path}/run={run}")


def read_slices(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All runs of a raw table with the column `run`; a filter on it prunes slices."""
    return read_table(spark, path, T.StructType([*schema.fields, T.StructField("run", T.StringType())]))


def overwrite(df: DataFrame, path: str) -> None:
    """Full refresh of a table."""
    df.write.mode("overwrite").parquet(path)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """One-row run state; no rows before the first run."""
    if not exists(spark, path):
        return spark.createDataFrame([], STATE)
    return spark.read.schema(STATE).json(path)


def write_state(spark: SparkSession, path: str, last_run: str, duration_s: float, last_event: str | None) -> None:
    row = spark.createDataFrame([(last_run, duration_s, last_event)], STATE)
    row.coalesce(1).write.mode("overwrite").json(path)


def append_audit(rows: DataFrame, path: str) -> None:
    """Add lines of finished job runs, with the columns of the audit table."""
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in AUDIT.fields]
    rows.select(*columns).coalesce(1).write.mode("append").parquet(path)


def write_audit(
    spark: SparkSession, path: str, job: str, duration_s: float, new_rows: int, last_key: str | None, status: str
) -> None:
    """One line per job run, also for a run without new rows and for a failed one."""
    now = datetime.now(timezone.utc)
    append_audit(spark.createDataFrame([(job, now, duration_s, new_rows, last_key, status)], AUDIT), path)


def stamped(df: DataFrame, column: str, value: Column | str | None) -> DataFrame:
    """Every row marked with one value of the run."""
    mark = value if isinstance(value, Column) else F.lit(value).cast("string")
    return df.withColumn(column, mark)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", **options) -> None:
    """Write to a database table in parallel batches. An overwrite empties the table and keeps its definition."""
    settings = {"batchsize": "10000", "numPartitions": "16", **options}
    if mode == "overwrite":
        settings.setdefault("truncate", "true")
    df.write.format("jdbc").options(url=url, dbtable=table, **settings).mode(mode).save()


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """Read a database table. Give partitionColumn, lowerBound, upperBound and numPartitions to read in parallel."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()

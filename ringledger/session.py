"""Spark session settings and the shared folder for intermediate tables."""

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # questions arrive as SQL with quoted column names, which would otherwise be read as text
    "spark.sql.ansi.doubleQuotedIdentifiers": "true",
    # a question reads registered views, never files by their path
    "spark.sql.runSQLOnFiles": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(name: str = "ringledger", master: str | None = None, **settings) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="ringledger-")


_RUN = uuid.uuid4().hex
_removed_at_end: set[str] = set()


def _remove_at_end(spark: SparkSession, folder: str) -> None:
    """The folder is removed when the driver's JVM ends."""
    jvm = getattr(spark.sparkContext, "_jvm", None)
    if jvm is None or folder in _removed_at_end:
        return
    path = jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path)
    system.deleteOnExit(path)
    _removed_at_end.add(folder)


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the cluster's `spark.checkpoint.dir`, kept until the application ends.

    Where the setting is empty, a local master gets a temporary folder; on a cluster it is an error, since
    executors could not see a folder of the driver's machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or None
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = _local_folder()
    run = f"{base.rstrip('/')}/ringledger/{_RUN}"
    _remove_at_end(spark, run)
    return f"{run}/{uuid.uuid4().hex}"

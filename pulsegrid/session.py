"""Session settings every job in this package relies on."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

# Correctness: timestamps are UTC. Scale: AQE re-plans joins, splits skewed
# join partitions and merges small shuffle partitions at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Files of a day are listed when a question asks for it, so that other applications' writes
    # are seen; the catalog says which days.
    "spark.sql.hive.filesourcePartitionFileCacheSize": "0",
}
# Fixed when the session starts. Saves a stack inspection per Column operation on the driver.
STATIC_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app: str = "pulsegrid", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **STATIC_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Where it is unset the SQL warehouse is used, which executors share as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it from there, so that what
    uses it twice computes it once and a lost executor costs nothing. The table is deleted by
    :func:`discard`, or when the application ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Delete tables that :func:`materialize` wrote and nothing will read again.

    The driver then collects its garbage: shuffle files of finished jobs are deleted when their
    plans are, which a large driver heap puts off for long.
    """
    for df in stored:
        where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)
    gc.collect()
    for df in stored[:1]:
        df.sparkSession._jvm.System.gc()

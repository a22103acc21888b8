"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings the operators are designed for. All of them are runtime settings of SQL.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # joins here have one row per key on one side, so a hot key can always be split on the other
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4_000_000


def build_session(master: str | None = None, app: str = "lakeops", **extra: str) -> SparkSession:
    """A session with `SETTINGS`; pass `master` for local use, leave it out under spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        # splits that don't follow the number of cores while executors come and go: lines are numbered per split
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`; where that is not set, a folder in the warehouse, which
    driver and executors share as well, and which goes when the session's process ends."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        root = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_lakeops_scratch")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir()
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the scratch root; nothing is there yet."""
    return os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex}")


def materialize_small(df: DataFrame, name: str, per_core: int = 4) -> DataFrame:
    """`materialize` for narrow tables that come out of many shuffle partitions: written by some tasks per core.

    Each file costs a process or two where Hadoop's native library is missing. Not for rows that know their partition's number.
    """
    return materialize(df.coalesce(per_core * df.sparkSession.sparkContext.defaultParallelism), name)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the scratch folder and read back.

    For small tables several parts of a plan need: they are computed once, survive lost executors, and their true size
    is known to the planner, which then decides about broadcasting them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def without_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries run in here remove their shuffle files as they end, not when the driver happens to collect its garbage."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLES_GO) if before is None else spark.conf.set(SHUFFLES_GO, before)


def few_bytes_a_batch(spark: SparkSession) -> None:
    """From now on rows go to Python by `BATCH_BYTES` at once, however long they are, not only by their number. This is for
    results that run Python when they are written, later on; `small_batches` is for what is written at once."""
    spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Queries run in here hand rows to Python by `BATCH_BYTES` at once, as after `few_bytes_a_batch`."""
    before = spark.conf.get(ARROW_BYTES)
    few_bytes_a_batch(spark)
    try:
        yield
    finally:
        spark.conf.set(ARROW_BYTES, before)


def path_exists(spark: SparkSession, path: str) -> bool:
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)

"""Incremental ingest: each run takes the files that are new since the last."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.plans.feeds import Feed, aside, held_days, load_files
from lakeops.session import materialize, path_exists
from lakeops.sources.folder import stamp_keys

FILES = "path string, modificationTime timestamp, length long, content binary"


def ingest_new_files(spark: SparkSession, feed: Feed, source: str, table: str, checkpoint: str, files_per_batch: int | None = None) -> None:
    """Read the files of a feed that are not yet seen and replace the days they hold.

    The stream is one of file names; contents are left where they are until it is known which files count, and then read
    exactly as the batch ingest reads them. Of several files for a day the greatest name counts, whichever batch each
    comes with: a ledger beside the target has a row for each file, its batch, what became of it and how many rows it
    gave. So the result does not depend on how files fall into batches, neither lines nor the target are read to learn
    names, and a batch repeated after a failure writes the same days and the same part of the ledger again. Files without a date
    or heading and cells that do not fit are appended to the tables beside the target, with the batch's number; a batch
    run twice replaces its own. Ends when all files present are done.
    """
    reader = spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", feed.naming.glob).option("recursiveFileLookup", True)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    paths = reader.load(source).select(F.col("path").alias("file_path"), F.element_at(F.split("path", "/"), -1).alias("file_name"))
    if feed.naming.skip:
        paths = paths.where(~F.col("file_name").isin(*feed.naming.skip))

    def write(batch: DataFrame, number: int) -> None:
        load = f"{zlib.crc32(checkpoint.encode()):08x}-{number}"
        files = materialize(stamp_keys(batch, feed.naming), "batch-files")
        for what, rows in load_files(spark, feed, files, table, load, held_days(spark, table, load)).items():
            if path_exists(spark, aside(table, what)) and rows.isEmpty():
                continue
            told = rows.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            told.partitionBy("batch").parquet(aside(table, what))

    query = paths.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()

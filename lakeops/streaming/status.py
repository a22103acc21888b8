"""Close-of-day progress from a stream of stage events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def done_branches(events: DataFrame, late: str = "1 day") -> DataFrame:
    """branch_date, no_of_eoc_branch: distinct branches done so far, for events with branch_date (a date) and
    branch_code. Run it in update mode: a day's count comes out again whenever it has grown.

    A stream cannot count distinct values, so repeats are dropped first. Time in this stream is the branch date itself:
    a branch and day is remembered until the stream has come `late` beyond that day, and an event of an older day is
    dropped, not counted once more. So a repeat never counts twice, however much later it comes; a branch first told
    of when its day is past by more than `late` is not counted. State is one entry per branch and count per day of that time.
    """
    dated = events.withColumn("_day", F.col("branch_date").cast("timestamp")).withWatermark("_day", late)
    first = dated.dropDuplicates(["_day", "branch_code"])
    counts = first.groupBy("_day").agg(F.count("*").alias("no_of_eoc_branch"))
    return counts.select(F.to_date("_day").alias("branch_date"), "no_of_eoc_branch")


def append_changes(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Each trigger appends the counts that changed, with the batch number; a batch run twice replaces its own."""

    def write(batch: DataFrame, number: int) -> None:
        out = batch.withColumn("batch", F.lit(number))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)

    writer = counts.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def latest_counts(snapshots: DataFrame) -> DataFrame:
    """The newest count of each day from the appended changes."""
    return snapshots.groupBy("branch_date").agg(F.max_by("no_of_eoc_branch", "batch").alias("no_of_eoc_branch"))

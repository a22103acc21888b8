"""Streams that take what is there and end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.plans.feeds import CATEGORIES, LOGINS
from lakeops.session import scratch_path
from lakeops.sources.files import read_table
from lakeops.streaming.ingest import ingest_new_files
from lakeops.streaming.status import append_changes, done_branches, latest_counts
from suite.registry import plain, query, table
from suite.storage import CATEGORY_SQL, LOGIN_SQL, category_files, keys_as_text, login_files


@query(CATEGORY_SQL)
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """New files only, a few per batch, run twice: the second run finds nothing to do. Files and rows are those of
    `ingest_folder`."""
    source, target, progress = (scratch_path(spark, name) for name in ("source", "categories", "progress"))
    category_files(spark, sf, source)
    for _ in range(2):
        ingest_new_files(spark, CATEGORIES, source, target, progress, files_per_batch=9)
    return plain(keys_as_text(read_table(spark, target)))


@query(LOGIN_SQL)
def stream_login_log(spark: SparkSession, sf: str) -> DataFrame:
    """Login logs, repaired as they arrive."""
    source, target, progress = (scratch_path(spark, name) for name in ("source", "logins", "progress"))
    login_files(spark, sf, source)
    ingest_new_files(spark, LOGINS, source, target, progress, files_per_batch=5)
    return plain(keys_as_text(read_table(spark, target)))


@query(
    """
    SELECT strftime(ts, '%Y-%m-%d') AS branch_date, count(DISTINCT user_id) AS no_of_eoc_branch
    FROM events WHERE event_type = 'purchase' GROUP BY 1
    """
)
def stream_status(spark: SparkSession, sf: str) -> DataFrame:
    """Branches done per day from a stream of stage events, eight days a batch. Every event comes again one and four days
    later, the last time after its day is closed."""
    source, target, progress = (scratch_path(spark, name) for name in ("events", "counts", "progress"))
    events = table(spark, sf, "events").select("event_type", F.col("user_id").alias("branch_code"), F.to_date("ts").alias("branch_date"), F.explode(F.array(F.lit(0), F.lit(1), F.lit(4))).alias("later"))
    events = events.withColumn("batch", F.floor(F.unix_date(F.date_add("branch_date", F.col("later"))) / 8)).drop("later")
    batches = [r[0] for r in events.select("batch").distinct().orderBy("batch").collect()]
    for batch in batches:
        events.where(F.col("batch") == batch).drop("batch").write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.drop("batch").schema).parquet(source)
        done = done_branches(stream.where("event_type = 'purchase'"))
        append_changes(done, target, progress).awaitTermination()
    return plain(latest_counts(read_table(spark, target)))

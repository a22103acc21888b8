"""Tables in buckets: the buckets that a slice meets rewritten, snapshots compared by digests."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.hashing import row_hash
from lakeops.operators.upsert import upsert_day
from lakeops.session import scratch_path
from lakeops.sinks.buckets import BucketTable, change_classes
from suite.merges import KEYS, MATCH, category_rows, upsert_steps
from suite.registry import plain, query, table

LAST_DAY = "created >= TIMESTAMP '2001-08-01 00:00:00'"


@query(upsert_steps([LAST_DAY], False, f"NOT ({LAST_DAY})"))
def upsert_touched_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """The last day into a table in buckets of a key; the others keep their files."""
    rows = category_rows(spark, sf)
    last_day = F.col("created") >= F.lit(datetime(2001, 8, 1))
    base = BucketTable(scratch_path(spark, "categories"), ("level_3",), 128)
    base.create(rows.where(~last_day))
    base.merge(rows.where(last_day), lambda part, s: upsert_day(part, s, KEYS, "status", MATCH, ["last_updated"]))
    return plain(base.read(spark))


@query(
    """
    WITH e AS (SELECT user_id * 24 + hour(ts) AS id, event_type AS name, ts FROM events),
    cut AS (SELECT max(ts) - INTERVAL 1 HOUR AS cut FROM events),
    t AS (SELECT id, md5(id::VARCHAR || '|' || arg_max(name, ts)) AS rowhash FROM e, cut WHERE ts < cut GROUP BY id),
    s AS (SELECT id, arg_max(name, ts) AS name, md5(id::VARCHAR || '|' || arg_max(name, ts)) AS rowhash
          FROM e WHERE ts >= TIMESTAMP '2024-01-02 00:00:00' GROUP BY id)
    SELECT coalesce(s.id, t.id) AS id, s.name, s.rowhash,
           CASE WHEN t.id IS NULL THEN 'I' WHEN s.id IS NULL THEN 'D' WHEN t.rowhash <> s.rowhash THEN 'U' ELSE 'N' END AS iud_op
    FROM t FULL JOIN s ON t.id = s.id
    """
)
def change_classes_by_digest(spark: SparkSession, sf: str) -> DataFrame:
    """Each id's last event an hour before the end, and at the end without the first day: most buckets are alike."""
    events = table(spark, sf, "events").withColumn("id", F.col("user_id") * 24 + F.hour("ts"))
    end = events.agg(F.max("ts")).first()[0]

    def kept(rows: DataFrame, name: str) -> BucketTable:
        latest = rows.groupBy("id").agg(F.max_by("event_type", "ts").alias("name"))
        out = BucketTable(scratch_path(spark, name), ("id",), 128, ("id", "rowhash"))
        out.create(latest.withColumn("rowhash", row_hash(["id", "name"], "|")))
        return out

    current = kept(events.where(F.col("ts") < F.lit(end) - F.expr("INTERVAL 1 HOUR")), "current")
    incoming = kept(events.where(F.col("ts") >= F.lit(datetime(2024, 1, 2))), "incoming")
    return change_classes(spark, current, incoming, "id")

"""Merges of daily slices into a base table; the SQL runs the statements day by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.replace import collapse, delete_insert_range as delete_insert, watermark
from lakeops.operators.upsert import upsert_day as upsert_one
from lakeops.operators.upsert import upsert_range as upsert_many
from suite.registry import plain, query, stamp_text, table

KEYS = ["level_1", "level_2", "level_3"]
MATCH = [*KEYS, "name", "created_user", "status", "updated_user"]
COLUMNS = [*KEYS, "name", "created_user", "created", "status", "updated_user", "last_updated", "file_name", "day_key"]

ROWS_SQL = """
    rows AS MATERIALIZED (
        SELECT (o_custkey % 5)::BIGINT AS level_1, (o_custkey % 25)::BIGINT AS level_2,
               CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_custkey END AS level_3,
               o_orderpriority AS name, 'u' || (o_orderkey % 2)::VARCHAR AS created_user, o_orderdate AS created,
               CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS status,
               CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'u1' END AS updated_user, o_orderdate AS last_updated,
               'f' || o_orderkey::VARCHAR AS file_name,
               year(o_orderdate)::INT * 10 + ((month(o_orderdate) + 5) // 6)::INT AS day_key
        FROM orders)
"""


def category_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as category rows, one slice per half-year; a few NULL keys, statuses and users."""
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        (F.col("o_custkey") % 5).alias("level_1"),
        (F.col("o_custkey") % 25).alias("level_2"),
        F.when(key % 17 != 0, F.col("o_custkey")).alias("level_3"),
        F.col("o_orderpriority").alias("name"),
        F.concat(F.lit("u"), key % 2).alias("created_user"),
        F.col("o_orderdate").alias("created"),
        F.when(key % 11 != 0, F.col("o_orderstatus")).alias("status"),
        F.when(key % 7 != 0, "u1").alias("updated_user"),
        F.col("o_orderdate").alias("last_updated"),
        F.concat(F.lit("f"), key).alias("file_name"),
        (F.year("o_orderdate") * 10 + F.expr("(month(o_orderdate) + 5) div 6").cast("int")).alias("day_key"),
    )


def upsert_steps(slices: list[str], null_safe: bool, start: str, keys: list[str] = KEYS) -> str:
    """UPDATE then INSERT for each slice, each as a step over the table before."""
    equal = "t.{0} IS NOT DISTINCT FROM s.{0}" if null_safe else "t.{0} = s.{0}"
    differ = "t.status IS DISTINCT FROM s.status" if null_safe else "t.status <> s.status"
    on_keys = " AND ".join(equal.format(k) for k in keys)
    on_match = " AND ".join(equal.format(c) for c in MATCH)
    best = ", ".join(f"s.{c} DESC NULLS LAST" for c in ["last_updated", *COLUMNS])
    new = ", ".join(f"CASE WHEN s.file_name IS NULL THEN t.{c} ELSE s.{c} END AS {c}" for c in COLUMNS)
    steps, base = [f"b0 AS MATERIALIZED (SELECT * FROM rows WHERE {start})"], "b0"
    for i, condition in enumerate(slices, 1):
        steps.append(
            f"""
            s{i} AS MATERIALIZED (SELECT * FROM rows WHERE {condition}),
            u{i} AS MATERIALIZED (
                SELECT {', '.join(COLUMNS)} FROM (
                    SELECT {new}, row_number() OVER (PARTITION BY t.rid ORDER BY {best}) AS rn
                    FROM (SELECT *, row_number() OVER () AS rid FROM {base}) t
                    LEFT JOIN s{i} s ON {on_keys} AND {differ}) WHERE rn = 1),
            b{i} AS MATERIALIZED (
                SELECT * FROM u{i} UNION ALL
                SELECT * FROM s{i} s WHERE NOT EXISTS (SELECT 1 FROM u{i} t WHERE {on_match}))"""
        )
        base = f"b{i}"
    stamps = ", ".join(f"{stamp_text(c)} AS {c}" for c in ["created", "last_updated"])
    return f"WITH {ROWS_SQL}, {', '.join(steps)} SELECT * REPLACE ({stamps}) FROM {base}"


LATER = "day_key > 20001"
HALF_YEARS = [f"day_key = {year}{half}" for year in range(1996, 2002) for half in (1, 2)]


def one_slice(spark: SparkSession, sf: str, null_safe: bool) -> DataFrame:
    rows = category_rows(spark, sf)
    base, later = rows.where(~F.expr(LATER)), rows.where(LATER)
    return plain(upsert_one(base, later, KEYS, "status", MATCH, ["last_updated"], null_safe))


def all_slices(spark: SparkSession, sf: str, null_safe: bool) -> DataFrame:
    rows = category_rows(spark, sf)
    base, later = rows.where("day_key < 19960"), rows.where("day_key >= 19960")
    return plain(upsert_many(base, later, "day_key", KEYS, "status", MATCH, ["last_updated"], null_safe))


@query(upsert_steps([LATER], False, f"NOT ({LATER})"))
def upsert_day(spark: SparkSession, sf: str) -> DataFrame:
    return one_slice(spark, sf, False)


@query(upsert_steps([LATER], True, f"NOT ({LATER})"))
def upsert_day_null_safe(spark: SparkSession, sf: str) -> DataFrame:
    return one_slice(spark, sf, True)


@query(upsert_steps(HALF_YEARS, False, "day_key < 19960"))
def upsert_range(spark: SparkSession, sf: str) -> DataFrame:
    return all_slices(spark, sf, False)


@query(upsert_steps(HALF_YEARS, True, "day_key < 19960"))
def upsert_range_null_safe(spark: SparkSession, sf: str) -> DataFrame:
    return all_slices(spark, sf, True)


MONTHS = [(year, month) for year in range(1999, 2002) for month in range(1, 13)]


@query(
    upsert_steps(
        [f"year(created) = {year} AND month(created) = {month}" for year, month in MONTHS],
        False,
        "year(created) < 1999",
        ["level_2"],
    )
)
def upsert_range_busy_keys(spark: SparkSession, sf: str) -> DataFrame:
    """A few keys with all statuses in every month."""
    rows = category_rows(spark, sf)
    year = F.year("created")
    base = rows.where(year < 1999)
    months = rows.where(year.between(1999, 2001)).withColumn("month", year * 100 + F.month("created"))
    return plain(upsert_many(base, months, "month", ["level_2"], "status", MATCH, ["last_updated"]))


EVENT_KEYS = ["level_1", "level_2", "status"]
EVENT_ROWS_SQL = """
    rows AS MATERIALIZED (
        SELECT user_id AS level_1, CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_type END AS level_2,
               (event_id % 3)::VARCHAR AS status, props AS name, date_trunc('minute', ts) AS created, ts AS last_updated,
               strftime(ts, '%Y%m%d')::INT AS day_key FROM events)
"""


def event_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("user_id").alias("level_1"),
        F.when(F.col("event_id") % 13 != 0, F.col("event_type")).alias("level_2"),
        (F.col("event_id") % 3).cast("string").alias("status"),
        F.col("props").alias("name"),
        F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("created"),
        F.col("ts").alias("last_updated"),
        F.date_format("ts", "yyyyMMdd").cast("int").alias("day_key"),
    )


def delete_insert_steps(days: range) -> str:
    on_keys = " AND ".join(f"t.{k} = s.{k}" for k in EVENT_KEYS)
    steps, base = ["b0 AS MATERIALIZED (SELECT * FROM rows WHERE day_key <= 20240110)"], "b0"
    for d in days:
        steps.append(
            f"""
            s{d} AS MATERIALIZED (SELECT * FROM rows WHERE day_key = {d}),
            b{d} AS MATERIALIZED (
                SELECT * FROM {base} t WHERE NOT EXISTS (SELECT 1 FROM s{d} s WHERE {on_keys})
                UNION ALL
                SELECT level_1, level_2, status, name, max(created), max(last_updated), day_key FROM s{d}
                GROUP BY level_1, level_2, status, name, day_key)"""
        )
        base = f"b{d}"
    stamps = ", ".join(f"{stamp_text(c)} AS {c}" for c in ["created", "last_updated"])
    return f"WITH {EVENT_ROWS_SQL}, {', '.join(steps)} SELECT * REPLACE ({stamps}) FROM {base}"


@query(delete_insert_steps(range(20240111, 20240131)))
def delete_insert_range(spark: SparkSession, sf: str) -> DataFrame:
    rows = event_rows(spark, sf)
    base = rows.where("day_key <= 20240110")
    return plain(delete_insert(base, rows, "day_key", EVENT_KEYS, ["created", "last_updated"], last=20240130))


@query(
    f"""
    WITH {EVENT_ROWS_SQL}
    SELECT level_1, level_2, status, name, {stamp_text('max(created)')} AS created,
           {stamp_text('max(last_updated)')} AS last_updated, day_key
    FROM rows GROUP BY level_1, level_2, status, name, day_key
    """
)
def collapse_groups(spark: SparkSession, sf: str) -> DataFrame:
    return plain(collapse(event_rows(spark, sf), ["created", "last_updated"]))


@query(f"WITH {EVENT_ROWS_SQL} SELECT max(day_key) AS max_day FROM rows")
def watermark_day(spark: SparkSession, sf: str) -> DataFrame:
    return watermark(event_rows(spark, sf), "day_key")

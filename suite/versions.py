"""Versioned history; the SQL closes and opens versions day by day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.hashing import plain_hash, row_hash
from lakeops.operators.history import classify_changes, one_per_day, replay, restore_day, retract
from suite.registry import day_text, plain, query, table

# An id is a user and an hour of the day; its snapshot of a day is the last event of it.
SNAPSHOTS_SQL = """
    snap AS MATERIALIZED (
        SELECT id, event_type AS name, cents AS level, d AS data_date,
               md5(id::VARCHAR || '|' || event_type || '|' || (cents % 4)::VARCHAR) AS rowhash
        FROM (SELECT user_id * 24 + hour(ts) AS id, event_type, round(value * 100)::BIGINT AS cents, ts::DATE AS d,
                     row_number() OVER (PARTITION BY user_id, hour(ts), ts::DATE ORDER BY ts DESC) AS rn FROM events)
        WHERE rn = 1)
"""
SPANS = f"{day_text('from_date')} AS from_date, {day_text('to_date')} AS to_date"


def base_sql(last: str) -> str:
    return f"""
    b0 AS MATERIALIZED (
        SELECT id, name, level, data_date AS from_date,
               coalesce(lead(data_date) OVER w - 1, DATE '9999-12-31') AS to_date,
               CASE WHEN lead(data_date) OVER w IS NULL THEN 1 ELSE 0 END AS is_current, rowhash
        FROM snap WHERE data_date <= DATE '{last}' WINDOW w AS (PARTITION BY id ORDER BY data_date))
    """


def replay_steps(first: int, last: int, change_only: bool = False, insert_new: bool = False, base: str = "b0") -> str:
    steps = []
    for n in range(first, last + 1):
        d = f"DATE '2024-01-{n:02d}'"
        changed = "AND t.rowhash IS DISTINCT FROM s.rowhash" if change_only else ""
        how = "LEFT JOIN" if insert_new else "JOIN"
        only = "WHERE t.id IS NULL OR t.rowhash IS DISTINCT FROM s.rowhash" if change_only else ""
        steps.append(
            f"""
            i{n} AS MATERIALIZED (
                SELECT s.* FROM (SELECT * FROM snap WHERE data_date = {d}) s
                {how} (SELECT * FROM {base} WHERE is_current = 1) t ON t.id = s.id {only}),
            b{n} AS MATERIALIZED (
                SELECT t.id, t.name, t.level, t.from_date,
                       CASE WHEN t.is_current = 1 AND s.id IS NOT NULL THEN {d} - 1 ELSE t.to_date END AS to_date,
                       CASE WHEN s.id IS NOT NULL THEN 0 ELSE t.is_current END AS is_current, t.rowhash
                FROM {base} t LEFT JOIN i{n} s ON t.id = s.id {changed}
                UNION ALL
                SELECT id, name, level, {d}, DATE '9999-12-31', 1, rowhash FROM i{n})"""
        )
        base = f"b{n}"
    return ", ".join(steps)


def retract_sql(out: str, base: str, gone: str, first: str, last: str) -> str:
    again = f"to_date BETWEEN DATE '{first}' AND DATE '{last}' AND is_current = 0"
    return f"""
    {out} AS MATERIALIZED (
        SELECT * REPLACE (CASE WHEN {again} THEN DATE '9999-12-31' ELSE to_date END AS to_date,
                          CASE WHEN {again} THEN 1 ELSE is_current END AS is_current)
        FROM {base} WHERE NOT ({gone}))
    """


def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(
        (F.col("user_id") * 24 + F.hour("ts")).alias("id"),
        F.col("event_type").alias("name"),
        F.round(F.col("value") * 100).cast("bigint").alias("level"),
        F.to_date("ts").alias("data_date"),
        "ts",
    )
    return one_per_day(events, "id", "data_date", ["ts"]).drop("ts")


def hashed() -> Column:
    return F.md5(F.concat_ws("|", F.col("id"), F.col("name"), F.col("level") % 4))


EMPTY = "id bigint, name string, level bigint, from_date date, to_date date, is_current int, rowhash string"
FIRST, LAST = date(2024, 1, 1), date(2024, 1, 30)


def history_until(spark: SparkSession, snaps: DataFrame, last: date) -> DataFrame:
    return replay(spark.createDataFrame([], EMPTY), snaps, "id", FIRST, last, hashed(), insert_new=True)


def replayed(spark: SparkSession, sf: str, **options) -> DataFrame:
    snaps = snapshots(spark, sf)
    base = history_until(spark, snaps, date(2024, 1, 10))
    return plain(replay(base, snaps, "id", date(2024, 1, 11), LAST, hashed(), **options))


@query(f"WITH {SNAPSHOTS_SQL}, {base_sql('2024-01-10')}, {replay_steps(11, 30)} SELECT * REPLACE ({SPANS}) FROM b30")
def history_replay(spark: SparkSession, sf: str) -> DataFrame:
    return replayed(spark, sf)


@query(
    f"WITH {SNAPSHOTS_SQL}, {base_sql('2024-01-10')}, {replay_steps(11, 30, True, True)} SELECT * REPLACE ({SPANS}) FROM b30"
)
def history_replay_changes(spark: SparkSession, sf: str) -> DataFrame:
    return replayed(spark, sf, change_only=True, insert_new=True)


@query(
    f"""
    WITH {SNAPSHOTS_SQL}, {base_sql('2024-01-30')},
    {retract_sql('r', 'b0', "from_date = DATE '2024-01-20'", '2024-01-14', '2024-01-19')}
    SELECT * REPLACE ({SPANS}) FROM r
    """
)
def history_retract(spark: SparkSession, sf: str) -> DataFrame:
    base = history_until(spark, snapshots(spark, sf), LAST)
    return plain(retract(base, date(2024, 1, 20), reopen=(date(2024, 1, 14), date(2024, 1, 19))))


@query(
    f"""
    WITH {SNAPSHOTS_SQL}, {base_sql('2024-01-20')},
    {retract_sql('r', 'b0', "from_date = DATE '2024-01-20' OR from_date BETWEEN DATE '2024-01-15' AND DATE '2024-01-19'",
                 '2024-01-15', '2024-01-19')},
    {replay_steps(15, 19, base='r')}
    SELECT * REPLACE ({SPANS}) FROM b19
    """
)
def history_correct(spark: SparkSession, sf: str) -> DataFrame:
    """Retract, then replay the days retracted; here the versions of those days are cleared first."""
    snaps = snapshots(spark, sf)
    first, last = date(2024, 1, 15), date(2024, 1, 19)
    base = history_until(spark, snaps, date(2024, 1, 20))
    undone = retract(base, date(2024, 1, 20), reopen=(first, last), clear_range=True)
    return plain(replay(undone, snaps, "id", first, last, hashed()))


@query(
    f"""
    WITH {SNAPSHOTS_SQL}, {base_sql('2024-01-20')},
    {retract_sql('r', 'b0', "from_date = DATE '2024-01-20'", '2024-01-19', '2024-01-19')},
    {replay_steps(19, 19, insert_new=True, base='r')}
    SELECT * REPLACE ({SPANS}) FROM b19
    """
)
def history_restore_day(spark: SparkSession, sf: str) -> DataFrame:
    snaps = snapshots(spark, sf)
    base = history_until(spark, snaps, date(2024, 1, 20))
    return plain(restore_day(base, snaps, "id", date(2024, 1, 20), date(2024, 1, 19), hashed()))


@query(
    """
    WITH e AS (SELECT user_id * 24 + hour(ts) AS id, event_type AS name, ts < DATE '2024-01-16' AS early, ts FROM events),
    l AS (SELECT id, early, arg_max(name, ts) AS name FROM e GROUP BY id, early),
    t AS (SELECT id, md5(id::VARCHAR || '|' || name) AS rowhash FROM l WHERE early),
    s AS (SELECT id, name, md5(id::VARCHAR || '|' || name) AS rowhash FROM l WHERE NOT early)
    SELECT coalesce(s.id, t.id) AS id, s.name, s.rowhash,
           CASE WHEN t.id IS NULL THEN 'I' WHEN s.id IS NULL THEN 'D' WHEN t.rowhash <> s.rowhash THEN 'U' ELSE 'N' END AS iud_op
    FROM t FULL JOIN s ON t.id = s.id
    """
)
def change_classes(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("id", F.col("user_id") * 24 + F.hour("ts"))
    early = F.col("ts") < F.lit(date(2024, 1, 16))

    def last(rows: DataFrame) -> DataFrame:
        latest = rows.groupBy("id").agg(F.max_by("event_type", "ts").alias("name"))
        return latest.withColumn("rowhash", row_hash(["id", "name"], "|"))

    return classify_changes(last(events.where(early)), last(events.where(~early)), "id")


@query(
    """
    SELECT c_custkey, md5(c_custkey::VARCHAR || '|' || c_name || '|' ||
                          coalesce(CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END, '~')) AS rowhash FROM customer
    """
)
def row_hashes(spark: SparkSession, sf: str) -> DataFrame:
    segment = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("segment")
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", segment)
    return rows.select("c_custkey", row_hash(["c_custkey", "c_name", "segment"], "|", "~").alias("rowhash"))


@query(
    """
    SELECT c_custkey, md5(c_custkey::VARCHAR || c_name || c_custkey::VARCHAR ||
                          coalesce(CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END, '')) AS rowhash FROM customer
    """
)
def row_hashes_plain(spark: SparkSession, sf: str) -> DataFrame:
    segment = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("segment")
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", segment)
    return rows.select("c_custkey", plain_hash(["c_custkey", "c_name", "c_custkey", "segment"]).alias("rowhash"))

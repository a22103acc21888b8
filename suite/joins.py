"""Joins, deletes and snapshot filters."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.counts import conditional_distinct
from lakeops.operators.mapping import sql_over
from lakeops.operators.quality import Rule, audit, evaluate
from lakeops.operators.rows import at_latest, beside, delete_matching, delete_where, join_on
from lakeops.sources.folder import only_days
from suite.registry import day_text, plain, query, table


@query(
    f"""
    SELECT o_orderkey, o_custkey, {day_text('o_orderdate')} AS day FROM orders
    WHERE o_orderdate IN (SELECT max(o_orderdate) FROM orders)
    """
)
def latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    return plain(at_latest(orders, "day"))


@query(
    """
    SELECT event_id, user_id FROM events
    WHERE ts::DATE = (SELECT max(ts)::DATE FROM events WHERE event_type = 'error') AND event_type <> 'error'
    """
)
def rows_at_other_tables_latest(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    errors = events.where("event_type = 'error'")
    return at_latest(events.where("event_type <> 'error'"), "day", errors, "day").select("event_id", "user_id")


@query(
    """
    SELECT o_orderpriority, c_mktsegment, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
    """
)
def inner_join(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey")
    joined = join_on(table(spark, sf, "orders"), customer, ["o_custkey"])
    return joined.groupBy("o_orderpriority", "c_mktsegment").agg(F.count("*").alias("n"))


@query(
    """
    SELECT c_custkey, c_name, big.n AS n_big, urgent.n AS n_urgent FROM customer
    LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_totalprice > 400000 GROUP BY 1) big
           ON c_custkey = big.o_custkey
    LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) urgent
           ON c_custkey = urgent.o_custkey
    """
)
def left_joins_of_aggregates(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    per = lambda rows, name: rows.groupBy("c_custkey").agg(F.count("*").alias(name))
    big = per(orders.where("o_totalprice > 400000"), "n_big")
    urgent = per(orders.where("o_orderpriority = '1-URGENT'"), "n_urgent")
    people = table(spark, sf, "customer").select("c_custkey", "c_name")
    return join_on(join_on(people, big, ["c_custkey"], "left"), urgent, ["c_custkey"], "left")


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def semi_join(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return join_on(table(spark, sf, "customer"), orders, ["c_custkey"], "left_semi").select("c_custkey", "c_name")


NULLED = "CASE WHEN event_id % 10 = 0 THEN NULL ELSE event_type END"


@query(
    f"""
    WITH e AS (SELECT event_id, user_id, {NULLED} AS kind, ts < DATE '2024-01-16' AS early FROM events)
    SELECT event_id, user_id, kind FROM e t WHERE NOT early AND NOT EXISTS (
        SELECT 1 FROM e s WHERE s.early AND s.user_id = t.user_id AND s.kind = t.kind AND s.event_id % 100 = t.event_id % 100)
    """
)
def anti_join(spark: SparkSession, sf: str) -> DataFrame:
    """A NULL in a key equals nothing, so such rows always stay."""
    events = table(spark, sf, "events").select(
        "event_id",
        "user_id",
        F.when(F.col("event_id") % 10 != 0, F.col("event_type")).alias("kind"),
        (F.col("event_id") % 100).alias("bucket"),
        (F.col("ts") < F.lit(date(2024, 1, 16))).alias("early"),
    )
    late, early = events.where("NOT early"), events.where("early")
    return join_on(late, early, ["user_id", "kind", "bucket"], "left_anti").select("event_id", "user_id", "kind")


@query(
    """
    SELECT o_orderkey, o_custkey FROM orders o WHERE NOT EXISTS (
        SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')
    """
)
def delete_matching_keys(spark: SparkSession, sf: str) -> DataFrame:
    returned = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return delete_matching(table(spark, sf, "orders"), returned, ["o_orderkey"]).select("o_orderkey", "o_custkey")


@query(f"SELECT event_id, {NULLED} AS kind FROM events WHERE ({NULLED} = 'error') IS NOT TRUE")
def delete_where_true(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("event_id") % 10 != 0, F.col("event_type")).alias("kind")
    return delete_where(table(spark, sf, "events").select("event_id", kind), F.col("kind") == "error")


@query(
    """
    SELECT u.n AS n_users, d.day, d.n AS n_done FROM (SELECT count(DISTINCT user_id) AS n FROM events) u
    CROSS JOIN (SELECT strftime(ts, '%Y-%m-%d') AS day, count(DISTINCT user_id) AS n FROM events
                WHERE ts::DATE = (SELECT max(ts)::DATE FROM events) GROUP BY 1) d
    """
)
def one_row_cross_join(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    users = events.agg(F.count_distinct("user_id").alias("n_users"))
    done = at_latest(events, "day").groupBy("day").agg(F.count_distinct("user_id").alias("n_done"))
    return plain(beside(users, done))


@query(
    """
    SELECT l_suppkey, count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_partkey END) AS returned,
           count(DISTINCT CASE WHEN l_returnflag = 'A' THEN l_partkey END) AS accepted,
           count(DISTINCT CASE WHEN l_linestatus = 'O' THEN l_partkey END) AS open,
           count(DISTINCT CASE WHEN l_quantity > 25 THEN l_partkey END) AS large,
           count(DISTINCT CASE WHEN l_discount >= 0.05 THEN l_partkey END) AS reduced,
           count(DISTINCT CASE WHEN l_tax = 0 THEN l_partkey END) AS untaxed,
           count(DISTINCT CASE WHEN l_linenumber = 1 THEN l_partkey END) AS first_line,
           count(DISTINCT CASE WHEN year(l_shipdate) = 1998 THEN l_partkey END) AS in_1998,
           count(DISTINCT CASE WHEN month(l_shipdate) = 12 THEN l_partkey END) AS december,
           count(DISTINCT CASE WHEN l_extendedprice < 10000 THEN l_partkey END) AS cheap
    FROM lineitem GROUP BY l_suppkey
    """
)
def conditional_distinct_counts(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    tests = {
        "returned": c("l_returnflag") == "R",
        "accepted": c("l_returnflag") == "A",
        "open": c("l_linestatus") == "O",
        "large": c("l_quantity") > 25,
        "reduced": c("l_discount") >= 0.05,
        "untaxed": c("l_tax") == 0,
        "first_line": c("l_linenumber") == 1,
        "in_1998": (c("l_shipdate") >= F.lit(date(1998, 1, 1))) & (c("l_shipdate") < F.lit(date(1999, 1, 1))),
        "december": F.month("l_shipdate") == 12,
        "cheap": c("l_extendedprice") < 10000,
    }
    return conditional_distinct(table(spark, sf, "lineitem"), ["l_suppkey"], "l_partkey", tests)


@query(
    """
    SELECT o_orderstatus, count(DISTINCT o_custkey) AS n_customers, strftime(min(o_orderdate), '%Y-%m-%d') AS first_day,
           strftime(max(o_orderdate), '%Y-%m-%d') AS last_day
    FROM orders WHERE o_orderpriority <> '5-LOW' AND o_orderdate BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
    GROUP BY o_orderstatus
    """
)
def sql_over_frames(spark: SparkSession, sf: str) -> DataFrame:
    text = """
        SELECT o_orderstatus, count(DISTINCT o_custkey) AS n_customers,
               date_format(min(o_orderdate), 'yyyy-MM-dd') AS first_day, date_format(max(o_orderdate), 'yyyy-MM-dd') AS last_day
        FROM {placed} WHERE o_orderpriority <> '5-LOW'
          AND o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '2001-01-01'
        GROUP BY o_orderstatus
    """
    return sql_over(spark, text, placed=table(spark, sf, "orders"))


@query(
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS day_key FROM orders
    WHERE strftime(o_orderdate, '%Y%m%d') BETWEEN '19990101' AND '19990331'
    """
)
def staging_slice(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("day_key"))
    return only_days(orders, "19990101", "19990331")


@query(
    """
    SELECT 'ColumnCount > 0' AS rule, 11::BIGINT AS value, true AS passed
    UNION ALL SELECT 'ColumnCount = 12', 11, false
    UNION ALL SELECT 'RowCount >= 1', count(*), count(*) >= 1 FROM lineitem
    """
)
def quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    rules = [Rule("ColumnCount", ">", 0), Rule("ColumnCount", "=", 12), Rule("RowCount", ">=", 1)]
    return evaluate(table(spark, sf, "lineitem"), rules)


@query(
    """
    WITH b AS (SELECT * FROM orders WHERE o_orderdate < DATE '2000-01-01'),
         s AS (SELECT * FROM orders WHERE o_orderdate >= DATE '2000-01-01')
    SELECT 'delete by key' AS operator, 'base' AS step, count(*) AS n_rows FROM b
    UNION ALL SELECT 'delete by key', 'slice', count(*) FROM s
    UNION ALL SELECT 'delete by key', 'result', count(*) FROM b WHERE o_custkey NOT IN (SELECT o_custkey FROM s)
    """
)
def audit_counts(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    later = F.col("o_orderdate") >= F.lit(date(2000, 1, 1))
    base, new = orders.where(~later), orders.where(later)
    return audit("delete by key", base=base, slice=new, result=delete_matching(base, new, ["o_custkey"]))

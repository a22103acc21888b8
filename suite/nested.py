"""JSON text, grids, nested records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.jsoncols import list_length, list_long, list_text, list_wide
from lakeops.operators.mapping import flatten_paths, project_paths
from lakeops.sources.grid import grid_to_columns, grid_to_json
from suite.registry import query, table

KEY = "second_related_phone_json"


def phones(spark: SparkSession, sf: str) -> DataFrame:
    """A phone cell per customer: one number, several quoted ones, several bare ones, missing, empty."""
    key = F.col("c_custkey")
    number = F.concat(F.lit("09"), F.lpad(key.cast("string"), 6, "0"))
    cell = (
        F.when(key % 5 == 0, number)
        .when(key % 5 == 1, F.concat(F.lit('"'), number, F.lit('", "'), number, F.lit('1"')))
        .when(key % 5 == 2, F.concat(number, F.lit(","), number, F.lit("1, "), number, F.lit("2")))
        .when(key % 5 == 3, "nan")
        .when(key % 10 == 4, "")
    )
    return table(spark, sf, "customer").select("c_custkey", cell.alias("phones"))


NUMBER_SQL = "'09' || lpad(c_custkey::VARCHAR, 6, '0')"
LIST_SQL = f"""
    SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN [{NUMBER_SQL}] WHEN 1 THEN [{NUMBER_SQL}, {NUMBER_SQL} || '1']
                      WHEN 2 THEN [{NUMBER_SQL}, {NUMBER_SQL} || '1', {NUMBER_SQL} || '2'] END AS numbers FROM customer
"""


def with_lists(spark: SparkSession, sf: str) -> DataFrame:
    return phones(spark, sf).withColumn("phones", list_text(F.col("phones"), KEY))


@query(
    f"""
    SELECT c_custkey, CASE WHEN numbers IS NOT NULL THEN
               '{{"{KEY}":["' || array_to_string(numbers, '","') || '"]}}' END AS phones,
           len(numbers)::INT AS n, CASE c_custkey % 5 WHEN 0 THEN '{{"impact":["' || {NUMBER_SQL} || '"]}}'
               WHEN 1 THEN '{{"impact":["' || array_to_string(numbers, ', ') || '"]}}'
               WHEN 2 THEN '{{"impact":["' || {NUMBER_SQL} || ',' || {NUMBER_SQL} || '1, ' || {NUMBER_SQL} || '2"]}}' END AS single
    FROM ({LIST_SQL})
    """
)
def json_list_build(spark: SparkSession, sf: str) -> DataFrame:
    raw = phones(spark, sf)
    lists = raw.select("c_custkey", list_text(F.col("phones"), KEY).alias("phones"), list_text(F.col("phones"), "impact", True).alias("single"))
    return lists.withColumn("n", list_length(F.col("phones"), KEY))


@query(
    f"""
    SELECT c_custkey, numbers[1] AS phone_number_0, numbers[2] AS phone_number_1, numbers[3] AS phone_number_2 FROM ({LIST_SQL})
    """
)
def json_list_wide(spark: SparkSession, sf: str) -> DataFrame:
    return list_wide(with_lists(spark, sf), "phones", KEY, width=3)


@query(
    f"""
    SELECT c_custkey, (i - 1)::INT AS position, numbers[i] AS phone_number
    FROM (SELECT *, unnest(range(1, len(numbers) + 1)) AS i FROM ({LIST_SQL}) WHERE numbers IS NOT NULL)
    """
)
def json_list_long(spark: SparkSession, sf: str) -> DataFrame:
    return list_long(with_lists(spark, sf), "phones", KEY)


@query(f"SELECT len(numbers)::INT AS n, count(*) AS n_rows FROM ({LIST_SQL}) GROUP BY 1")
def json_list_lengths(spark: SparkSession, sf: str) -> DataFrame:
    lengths = with_lists(spark, sf).select(list_length(F.col("phones"), KEY).alias("n"))
    return lengths.groupBy("n").agg(F.count("*").alias("n_rows"))


def sheets(spark: SparkSession, sf: str) -> DataFrame:
    """A sheet per order: a title, the heading (one name twice), a full row, a short one, and a long one."""
    cell = lambda c: F.col(c).cast("string")
    grid = F.array(
        F.array(F.lit("Title")),
        F.array(F.lit("Order"), F.lit("Status"), F.lit("Priority"), F.lit("Status")),
        F.array(cell("o_orderkey"), F.lit("old"), cell("o_orderpriority"), cell("o_orderstatus")),
        F.array(cell("o_orderkey"), F.lit("short")),
        F.array(cell("o_orderkey"), F.lit("x"), F.lit('say "hi"'), cell("o_orderstatus"), F.lit("beyond")),
    )
    body = F.to_json(F.struct(grid.alias("values")))
    return table(spark, sf, "orders").select("o_orderkey", body.alias("body"))


@query(
    """
    SELECT o_orderkey, p AS position, o_orderkey::VARCHAR AS "Order",
           CASE WHEN p <> 1 THEN o_orderstatus END AS "Status",
           CASE p WHEN 0 THEN o_orderpriority WHEN 2 THEN 'say "hi"' END AS "Priority", NULL::VARCHAR AS "Absent"
    FROM orders, (SELECT unnest([0, 1, 2])::INT AS p)
    """
)
def grid_to_records(spark: SparkSession, sf: str) -> DataFrame:
    return grid_to_columns(sheets(spark, sf), "body", ["Order", "Status", "Priority", "Absent"], header_row=1)


@query(
    """
    SELECT o_orderkey, p AS position, '{"Order":"' || o_orderkey::VARCHAR || '","Priority":' ||
           CASE p WHEN 0 THEN '"' || o_orderpriority || '"' WHEN 1 THEN 'null' ELSE '"say \\"hi\\""' END || ',"Status":' ||
           CASE p WHEN 1 THEN 'null' ELSE '"' || o_orderstatus || '"' END || '}' AS record
    FROM orders, (SELECT unnest([0, 1, 2])::INT AS p)
    """.replace("\\\\", "\\")
)
def grid_to_json_lines(spark: SparkSession, sf: str) -> DataFrame:
    return grid_to_json(sheets(spark, sf), "body", header_row=1)


def nested_events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.struct(
            F.col("event_id").cast("string").alias("id"),
            F.struct(F.col("event_type").alias("kind"), F.array("event_type", "props").alias("keys")).alias("what"),
        ).alias("idinfo"),
        F.struct(
            F.struct(F.col("value").cast("string").alias("eastbc"), F.lit("north").alias("northbc")).alias("bounding"),
            F.col("ts").alias("when"),
            F.lit("unused").alias("extra"),
        ).alias("spdom"),
        F.lit(0).alias("other"),
    )


PATHS = [
    ("idinfo.id", "int"),
    ("idinfo.what.kind", "string"),
    ("idinfo.what.keys", "array"),
    ("spdom.bounding.eastbc", "double"),
    ("spdom.bounding.northbc", "double"),
    ("spdom.when", "string"),
]


@query(
    f"""
    SELECT event_id::INT AS idinfo_id, event_type AS idinfo_what_kind, event_type || ';' || props AS idinfo_what_keys,
           value AS spdom_bounding_eastbc, NULL::DOUBLE AS spdom_bounding_northbc, strftime(ts, '%Y-%m-%d') AS spdom_when
    FROM events
    """
)
def nested_paths_flat(spark: SparkSession, sf: str) -> DataFrame:
    flat = flatten_paths(nested_events(spark, sf), PATHS)
    return flat.withColumns(
        {"idinfo_what_keys": F.array_join("idinfo_what_keys", ";"), "spdom_when": F.left("spdom_when", F.lit(10))}
    )


@query(
    """
    SELECT event_id::INT AS id, event_type AS kind, value AS east, 'id,what' AS idinfo_fields, 'bounding,when' AS spdom_fields
    FROM events
    """
)
def nested_paths_kept(spark: SparkSession, sf: str) -> DataFrame:
    kept = project_paths(nested_events(spark, sf), PATHS)
    fields = {name: F.lit(",".join(kept.schema[name].dataType.names)) for name in kept.columns}
    return kept.select(
        F.col("idinfo.id").alias("id"),
        F.col("idinfo.what.kind").alias("kind"),
        F.col("spdom.bounding.eastbc").alias("east"),
        *[c.alias(f"{name}_fields") for name, c in fields.items()],
    )

"""Repair of raw delimited text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators import repair
from lakeops.operators.repair import LOG
from lakeops.session import scratch_path
from lakeops.sources.files import read_lines
from suite.registry import query, table

CELLS = [*LOG.cells, LOG.spill]
STAMP_SQL = "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')"
ID_SQL = "(100000 + o_orderkey)::VARCHAR"
PHONE_SQL = "'09' || o_custkey::VARCHAR"


def parts() -> dict:
    return {
        "kind": F.col("o_orderkey") % 7,
        "id": (F.col("o_orderkey") + 100000).cast("string"),
        "phone": F.concat(F.lit("09"), "o_custkey"),
        "stamp": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
    }


def raw_lines(spark: SparkSession, sf: str) -> DataFrame:
    """A log line per order: good, comma in the name, blank, heading, cut heading, no stamp, six cells."""
    p = parts()
    line = (
        F.when(p["kind"] == 0, F.concat_ws(",", p["id"], p["phone"], F.lit("Ann Lee"), p["stamp"]))
        .when(p["kind"] == 1, F.concat_ws(",", p["id"], p["phone"], F.lit("Bob"), F.lit("Ray"), p["stamp"]))
        .when(p["kind"] == 2, "  ")
        .when(p["kind"] == 3, ",".join(LOG.cells))
        .when(p["kind"] == 4, LOG.id)
        .when(p["kind"] == 5, F.concat_ws(",", p["id"], p["phone"], F.lit("Hal")))
        .otherwise(F.concat_ws(",", p["phone"], p["phone"], F.lit(""), p["stamp"], F.lit("a"), F.lit("b")))
    )
    return table(spark, sf, "orders").select("o_orderkey", line.alias("value"))


SPLIT_SQL = f"""
    SELECT o_orderkey, k, CASE k WHEN 0 THEN {ID_SQL} WHEN 1 THEN {ID_SQL} WHEN 3 THEN 'Customer Id' WHEN 4 THEN 'Customer Id'
                            WHEN 5 THEN {ID_SQL} WHEN 6 THEN {PHONE_SQL} END AS "Customer Id",
           CASE WHEN k IN (0, 1, 5, 6) THEN {PHONE_SQL} WHEN k = 3 THEN 'Phone number' END AS "Phone number",
           CASE k WHEN 0 THEN 'Ann Lee' WHEN 1 THEN 'Bob' WHEN 3 THEN 'Customer Name' WHEN 5 THEN 'Hal' WHEN 6 THEN '' END
               AS "Customer Name",
           CASE k WHEN 0 THEN {STAMP_SQL} WHEN 1 THEN 'Ray' WHEN 3 THEN 'Login Time' WHEN 6 THEN {STAMP_SQL} END AS "Login Time",
           CASE k WHEN 1 THEN {STAMP_SQL} WHEN 6 THEN 'a' END AS spill
    FROM (SELECT *, o_orderkey % 7 AS k FROM orders)
"""


@query(f"SELECT * EXCLUDE (k) FROM ({SPLIT_SQL})")
def split_cells(spark: SparkSession, sf: str) -> DataFrame:
    return repair.split_cells(raw_lines(spark, sf))


@query(f"SELECT * EXCLUDE (k) FROM ({SPLIT_SQL}) WHERE k NOT IN (3, 4)")
def drop_headers(spark: SparkSession, sf: str) -> DataFrame:
    return repair.drop_headers(split_cells(spark, sf))


@query(f"SELECT * EXCLUDE (k) FROM ({SPLIT_SQL}) WHERE k <> 2")
def drop_empty(spark: SparkSession, sf: str) -> DataFrame:
    return repair.drop_empty(split_cells(spark, sf), CELLS)


@query(
    f"""
    SELECT o_orderkey, "Customer Id", "Phone number", CASE k WHEN 1 THEN 'Bob Ray' WHEN 3 THEN 'Customer Name Login Time'
                       ELSE "Customer Name" END AS "Customer Name",
           coalesce(spill, "Login Time") AS "Login Time"
    FROM ({SPLIT_SQL})
    """
)
def repair_delimiter(spark: SparkSession, sf: str) -> DataFrame:
    return repair.repair_delimiter(split_cells(spark, sf))


@query(f'SELECT * EXCLUDE (k) FROM ({SPLIT_SQL}) WHERE k NOT IN (2, 4)')
def drop_continuations(spark: SparkSession, sf: str) -> DataFrame:
    return repair.drop_continuations(split_cells(spark, sf))


def written(spark: SparkSession, sf: str, line, name: str) -> DataFrame:
    """One text value per order, line breaks included, written as files and read back line by line."""
    path = scratch_path(spark, name)
    table(spark, sf, "orders").select(line.alias("value")).write.text(path)
    return read_lines(spark, path)


def log_file(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """Records as in a login log: whole, broken in the name, broken with a blank line, unfinished, with noise."""
    p = parts()
    start = F.concat_ws(",", p["id"], p["phone"], F.lit("Cy"))
    tail = F.concat_ws(",", F.lit("Dee"), p["stamp"])
    line = (
        F.when(p["kind"] == 0, F.concat_ws("\n", start, tail))
        .when(p["kind"] == 1, F.concat_ws("\n", start, F.lit(""), tail))
        .when(p["kind"] == 2, start)
        .when(p["kind"] == 3, F.concat_ws("\n", F.lit(",".join(LOG.cells)), start, tail))
        .when(p["kind"] == 4, F.concat_ws(",", p["id"], p["phone"], F.lit("Bob"), F.lit("Ray"), p["stamp"]))
        .when(p["kind"] == 5, F.concat_ws("\n", F.lit(""), start, F.lit("Dee,12 Nov 2022")))
        .otherwise(F.concat_ws(",", p["id"], p["phone"], F.lit("Ann Lee"), p["stamp"]))
    )
    return written(spark, sf, line, name)


LOG_SQL = f"""
    SELECT {ID_SQL} AS "Customer Id", {PHONE_SQL} AS "Phone number",
           CASE o_orderkey % 7 WHEN 2 THEN 'Cy' WHEN 4 THEN 'Bob Ray' WHEN 6 THEN 'Ann Lee' WHEN 5 THEN {{short_name}}
                ELSE 'Cy Dee' END AS "Customer Name",
           CASE o_orderkey % 7 WHEN 2 THEN NULL WHEN 5 THEN '12 Nov 2022' ELSE {STAMP_SQL} END AS "Login Time"
    FROM orders
"""


@query(LOG_SQL.format(short_name="'Cy'"))
def repair_linebreak(spark: SparkSession, sf: str) -> DataFrame:
    """A tail of 11 to 18 characters fills the stamp but does not extend the name."""
    return repair.clean_log(log_file(spark, sf, "log")).select(*[f"`{c}`" for c in LOG.cells])


@query(LOG_SQL.format(short_name="'Cy Dee'"))
def repair_linebreak_any_length(spark: SparkSession, sf: str) -> DataFrame:
    rows = repair.split_cells(repair.data_lines(log_file(spark, sf, "log")))
    fixed = repair.repair_linebreak(repair.repair_delimiter(rows), LOG, None, None)
    return fixed.select(*[f"`{c}`" for c in LOG.cells])


PAIR_SQL = f"""
    SELECT {ID_SQL} || ',' || {PHONE_SQL} || ',Cy' AS first_line, 'Dee,' || {STAMP_SQL} AS second_line
    FROM (SELECT *, ['broken', 'blank between', 'cut', 'broken', 'comma', 'short tail', 'whole'][o_orderkey % 7 + 1] AS kind
          FROM orders)
    WHERE kind IN ('broken', 'blank between')
"""


@query(PAIR_SQL)
def detect_pairs(spark: SparkSession, sf: str) -> DataFrame:
    rows = repair.split_cells(repair.data_lines(log_file(spark, sf, "log")))
    return repair.pair_text(repair.detect_pairs(rows)).select("first_line", "second_line")


def fragment_file(spark: SparkSession, sf: str) -> DataFrame:
    """Records over one to four lines, with blank lines between."""
    p = parts()
    line = F.concat(
        F.when(p["kind"] > 4, "\n  \n").otherwise(""),
        p["id"],
        F.when(p["kind"] > 1, "\n ").otherwise(","),
        p["phone"],
        F.when(p["kind"] > 2, "\n").otherwise(" "),
        F.lit("Cy "),
        F.when(p["kind"] > 3, "\n\n").otherwise(""),
        p["stamp"],
        F.lit(" "),
    )
    return written(spark, sf, line, "fragments")


@query(
    f"""
    SELECT {ID_SQL} || CASE WHEN o_orderkey % 7 > 1 THEN ' ' ELSE ',' END || {PHONE_SQL} || ' Cy ' || {STAMP_SQL} AS record,
           true AS complete
    FROM orders
    """
)
def join_fragments(spark: SparkSession, sf: str) -> DataFrame:
    return repair.join_fragments(fragment_file(spark, sf)).select("record", "complete")

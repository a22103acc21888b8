"""Column operators: names, types, cleaning, keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.dates import date_keys, local_day_of, whole_years
from lakeops.functions.names import drop_spill, name_blank, rename_all, squeeze, underscore
from lakeops.functions.text import blanks_to_null, each_string, one_line, strip_quotes
from lakeops.operators.mapping import (
    Field,
    add_constants,
    add_missing,
    check_columns,
    count_unparsed as unparsed,
    map_columns as mapped,
)
from lakeops.plans.feeds import sheet_headings, with_later_columns
from lakeops.sources.folder import Naming, stamp_keys, undated
from suite.registry import plain, query, stamp_text, table


@query(
    """
    SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE source END AS source,
           CASE WHEN trim(lang) = '' OR doc_id % 5 = 0 THEN NULL ELSE lang END AS lang, md5(text) AS text_md5 FROM documents
    """
)
def blank_to_null(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select(
        "doc_id",
        F.when(F.col("doc_id") % 3 == 0, "   ").otherwise(F.col("source")).alias("source"),
        F.when(F.col("doc_id") % 5 == 0, "").otherwise(F.col("lang")).alias("lang"),
        "text",
    )
    return blanks_to_null(docs).select("doc_id", "source", "lang", F.md5("text").alias("text_md5"))


@query(
    r"""
    SELECT doc_id, md5(t) AS text_md5, length(t) AS n FROM (
        SELECT doc_id, regexp_replace(trim(replace(text, '"', '')), '\s+', ' ', 'g') AS t FROM documents)
    """
)
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    cleaned = each_string(each_string(docs, strip_quotes), one_line)
    return cleaned.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").cast("bigint").alias("n"))


def raw_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as a raw file would have them: all strings, awkward headings, some cells that do not parse."""
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        F.lpad(key.cast("string"), 12, "0").alias("Order Key"),
        F.col("o_custkey").cast("string").alias("cust.no"),
        F.when(key % 10 == 0, "n/a").otherwise(F.date_format("o_orderdate", "yyyyMMddHHmmss")).alias("Date Placed"),
        F.when(key % 8 == 0, "").otherwise(F.date_format("o_orderdate", "yyyy/MM/dd")).alias("day/placed"),
        F.when(key % 6 == 0, "12x").otherwise((key % 100).cast("string")).alias("size"),
        F.col("o_orderstatus").alias("trust_level"),
        F.lit("unused").alias("Extra"),
    )


RAW_FIELDS = [
    Field("order key", "order_key"),
    Field("cust.no", "cust_no", "bigint"),
    Field("date placed", "placed", "timestamp", "yyyyMMddHHmmss"),
    Field("day/placed", "day_placed", "date", "yyyy/MM/dd"),
    Field("size", "size", "int"),
    Field(("level", "trust_level"), "level"),
    Field("role", "role"),
]


@query(
    f"""
    SELECT lpad(o_orderkey::VARCHAR, 12, '0') AS order_key, o_custkey AS cust_no,
           CASE WHEN o_orderkey % 10 <> 0 THEN {stamp_text('o_orderdate')} END AS placed,
           CASE WHEN o_orderkey % 8 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day_placed,
           CASE WHEN o_orderkey % 6 <> 0 THEN (o_orderkey % 100)::INT END AS size, o_orderstatus AS level,
           NULL::VARCHAR AS role
    FROM orders
    """
)
def map_columns(spark: SparkSession, sf: str) -> DataFrame:
    return plain(mapped(raw_orders(spark, sf), RAW_FIELDS, missing="null"))


@query(
    """
    SELECT 0::BIGINT AS cust_no, count(*) FILTER (o_orderkey % 10 = 0) AS placed, 0::BIGINT AS day_placed,
           count(*) FILTER (o_orderkey % 6 = 0) AS size FROM orders
    """
)
def count_unparsed(spark: SparkSession, sf: str) -> DataFrame:
    return unparsed(raw_orders(spark, sf), RAW_FIELDS)


@query(
    """
    SELECT c_custkey AS no__of_customer, c_name AS name_title, c_mktsegment AS name_title_2, c_nationkey AS state_division
    FROM customer
    """
)
def normalise_headers_underscore(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    return rename_all(customer.toDF("No. of Customer", "Name/Title", "name title", "State/Division"), underscore)


@query("SELECT c_custkey AS center_code, c_name AS centername, c_mktsegment AS segment FROM customer")
def normalise_headers_squeeze(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey", "c_nationkey")
    raw = customer.toDF(" ", " Center\nName ", "Seg ment", "_c3", "_c4")
    return drop_spill(rename_all(name_blank(raw, "center_code"), squeeze), known=3)


@query("SELECT c_custkey AS customer_no, c_name AS full_name, c_mktsegment AS center_code FROM customer")
def normalise_headers_snake(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return sheet_headings(name_blank(customer.toDF("Customer No", "Full\r Name", ""), "center code", first_only=False))


@query(
    """
    SELECT c_custkey, c_name, NULL::VARCHAR AS source, NULL::VARCHAR AS role, NULL::INT AS age, 'load' AS step, 7 AS run
    FROM customer
    """
)
def add_missing_columns(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer").select("c_custkey", "c_name")
    full = add_missing(with_later_columns(customer), {"C_NAME": "string", "age": "int"})
    return add_constants(full, {"step": "load", "run": 7})


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def schema_check(spark: SparkSession, sf: str) -> DataFrame:
    return check_columns(table(spark, sf, "supplier"), ["S_ACCTBAL", "S_NAME", "S_NATIONKEY", "S_SUPPKEY"], ignore_case=True)


NAMED_SQL = "CASE WHEN o_orderkey % 9 = 0 THEN 'orders_99999999.csv' ELSE 'orders_' || strftime(o_orderdate, '%d%m%Y') || '.csv' END"


def named_files(spark: SparkSession, sf: str) -> DataFrame:
    """A file name for each order's day; some hold no date."""
    text = F.when(F.col("o_orderkey") % 9 == 0, "99999999").otherwise(F.date_format("o_orderdate", "ddMMyyyy"))
    name = F.concat(F.lit("orders_"), text, F.lit(".csv"))
    return table(spark, sf, "orders").select("o_orderkey", name.alias("file_name"))


@query(
    f"""
    SELECT o_orderkey, {NAMED_SQL} AS file_name, strftime(d, '%Y') AS year_key, strftime(d, '%Y%m') AS month_key,
           strftime(d, '%Y%m%d') AS day_key
    FROM (SELECT *, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderdate - INTERVAL 1 DAY END AS d FROM orders)
    """
)
def date_keys_of_names(spark: SparkSession, sf: str) -> DataFrame:
    return stamp_keys(named_files(spark, sf), Naming(pattern=r"_(\d{8})\.[^.]*$", fmt="ddMMyyyy"))


@query(
    f"""
    SELECT * FROM (SELECT o_orderkey::VARCHAR AS file_path, {NAMED_SQL} AS file_name FROM orders)
    WHERE try_strptime(file_name, 'orders_%d%m%Y.csv') IS NULL
    """
)
def undated_names(spark: SparkSession, sf: str) -> DataFrame:
    files = named_files(spark, sf).withColumn("file_path", F.col("o_orderkey").cast("string"))
    return undated(stamp_keys(files, Naming(pattern=r"_(\d{8})\.[^.]*$", fmt="ddMMyyyy")))


@query(
    """
    SELECT o_orderkey, year(o_orderdate)::INT AS year_key, strftime(o_orderdate, '%Y%m')::INT AS month_key,
           strftime(o_orderdate, '%Y%m%d')::INT AS day_key FROM orders
    """
)
def date_keys_as_numbers(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat(F.lit("center list "), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(".csv")).alias("file_name")
    naming = Naming(pattern=r"(\d{4})-(\d{2})-(\d{2})\.csv$", shift=0, as_int=True)
    return stamp_keys(table(spark, sf, "orders").select("o_orderkey", name), naming).drop("file_name")


@query(
    """
    SELECT o_orderkey, strftime(d, '%d%m%Y') AS day_key, strftime(d, '%m%Y') AS month_key
    FROM (SELECT o_orderkey, o_orderdate - INTERVAL 29 DAY AS d FROM orders)
    """
)
def date_keys_other_formats(spark: SparkSession, sf: str) -> DataFrame:
    keys = date_keys(F.to_date("o_orderdate"), -29, {"day_key": "ddMMyyyy", "month_key": "MMyyyy"})
    return table(spark, sf, "orders").select("o_orderkey", *[c.alias(name) for name, c in keys.items()])


@query("SELECT event_id, strftime(ts + INTERVAL 390 MINUTE, '%Y-%m-%d') AS day FROM events")
def local_days(spark: SparkSession, sf: str) -> DataFrame:
    return plain(table(spark, sf, "events").select("event_id", local_day_of(F.col("ts")).alias("day")))


@query("SELECT o_orderkey, datesub('year', o_orderdate::DATE, DATE '2003-07-15')::INT AS years FROM orders")
def service_years(spark: SparkSession, sf: str) -> DataFrame:
    years = whole_years(F.to_date("o_orderdate"), F.to_date(F.lit("2003-07-15")))
    return table(spark, sf, "orders").select("o_orderkey", years.alias("years"))

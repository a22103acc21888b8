"""Files and tables: written to the scratch folder and read back."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.mapping import flatten_paths, schema_for
from lakeops.plans.close_status import close_status, stamp_snapshot
from lakeops.plans.extracts import export_payroll, export_transactions, officer_list
from lakeops.plans.feeds import CATEGORIES, LOGINS, aside, centers, ingest
from lakeops.plans.metadata import PATHS, load_metadata
from lakeops.session import scratch_path
from lakeops.sinks import export, tables, versions
from lakeops.sources.files import (
    literal_rows,
    read_csv,
    read_json_lines,
    read_multiline_csv,
    read_table,
    read_xml,
    text_schema,
)
from lakeops.sources.folder import only_days
from suite.registry import plain, query, stamp_text, table
from suite.reports import close_tables


def write_named(df: DataFrame, folder: str, name: str, write, heads: DataFrame | None = None) -> None:
    """Write the rows of each value of `name` as one file called so below `folder`; `heads`, a few rows per file, come first,
    by their `_order`.

    A file is written by one task, so all else is done before: rows are computed by many tasks, in shares of bounded size, and
    stored compressed. The task of a file then puts its rows one behind the other as it reads them; nothing is sorted or
    held there, whatever the size of the file.
    """
    spark = df.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    stored = {f"{folder}-rows": df.hint("rebalance", name)}
    if heads is not None:
        stored = {f"{folder}-heads": heads.repartition(name).sortWithinPartitions(name, "_order").drop("_order"), **stored}
    fs = hadoop.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files: dict[str, list[DataFrame]] = {}
    for path, rows in stored.items():
        rows.write.partitionBy(name).option("compression", "zstd").parquet(path)
        schema = rows.drop(name).schema
        for part in fs.listStatus(hadoop.Path(path)):
            if part.isDirectory():
                called = part.getPath().getName().split("=", 1)[1]
                files.setdefault(called, []).append(spark.read.schema(schema).parquet(f"{path}/{part.getPath().getName()}"))

    def put(called: str) -> None:
        staging = f"{folder}-parts/{called}"
        write(reduce(DataFrame.unionByName, files[called]).coalesce(1).write, staging)
        [file] = [f.getPath() for f in fs.listStatus(hadoop.Path(staging)) if f.getPath().getName().startswith("part-")]
        fs.rename(file, hadoop.Path(folder, called))

    fs.mkdirs(hadoop.Path(folder))
    with ThreadPoolExecutor(16) as files_at_once:
        list(files_at_once.map(put, files))


def as_csv(writer, path: str) -> None:
    writer.option("header", True).csv(path)


@query(
    """
    SELECT lpad(o_orderkey::VARCHAR, 10, '0') AS id, o_orderstatus AS status, o_orderpriority AS "no. of, priority",
           CASE WHEN o_orderkey % 4 <> 0 THEN o_custkey::VARCHAR END AS customer FROM orders
    """
)
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    coded_orders(spark, sf).write.option("header", True).csv(path)
    return read_csv(spark, path)


def coded_orders(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        F.lpad(key.cast("string"), 10, "0").alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("no. of, priority"),
        F.when(key % 4 != 0, F.col("o_custkey").cast("string")).alias("customer"),
    )


@query(
    """
    SELECT lpad(o_orderkey::VARCHAR, 10, '0') AS a, o_orderstatus AS b, o_orderpriority AS c,
           CASE WHEN o_orderkey % 4 <> 0 THEN o_custkey::VARCHAR END AS d FROM orders
    """
)
def csv_other_format(spark: SparkSession, sf: str) -> DataFrame:
    """Another separator and quote, and columns known beforehand."""
    path = scratch_path(spark, "csv")
    coded_orders(spark, sf).write.options(header=True, sep="|", quote="'").csv(path)
    return read_csv(spark, path, ["a", "b", "c", "d"], sep="|", quote="'")


NOTES = ['5" pipe', 'he said "so"', 'line one\r\nline ""two""', "a\rb,c", '"', ""]

DOCUMENT_SQL = """
    SELECT doc_id::VARCHAR AS doc_id, md5(text) AS text_md5, source,
           CASE doc_id % 6 WHEN 0 THEN '5" pipe' WHEN 1 THEN 'he said "so"' WHEN 2 THEN 'line one' || chr(13) || chr(10) || 'line ""two""'
                WHEN 3 THEN 'a' || chr(13) || 'b,c' WHEN 4 THEN '"' ELSE '' END AS note
    FROM documents
"""


def quoted_cell(c: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))


def document_csv(spark: SparkSession, sf: str) -> str:
    """Whole texts with their line breaks, carriage returns and quotes; beside them notes, some with quotes but written
    without any. Lines end with a line feed in one half of the files and with a carriage return before it in the other."""
    folder = scratch_path(spark, "csv")
    note = F.get(F.array(*[F.lit(n) for n in NOTES]), F.col("doc_id") % 6)
    bare = (F.col("doc_id") % 6).isin(0, 1)
    line = F.concat_ws(",", "doc_id", F.when(bare, note).otherwise(quoted_cell(note)), quoted_cell(F.col("text")), "source")
    crlf = F.col("doc_id") % 20 < 10
    name = F.concat(F.lit("part_"), F.col("doc_id") % 10, F.when(crlf, "_crlf").otherwise("_lf"), F.lit(".csv"))
    rows = table(spark, sf, "documents").select(line.alias("value"), name.alias("_file"))
    heads = rows.select("_file").distinct().select(F.lit(-1).cast("long").alias("_order"), F.lit("doc_id,note,text,source").alias("value"), "_file")
    ended = F.when(F.col("_file").contains("_crlf"), F.concat("value", F.lit("\r"))).otherwise(F.col("value"))
    blank = heads.select(F.lit(-2).cast("long").alias("_order"), F.lit("").alias("value"), "_file")
    heads = heads.unionByName(blank).withColumn("value", ended)
    write_named(rows.withColumn("value", ended), folder, "_file", lambda writer, path: writer.text(path), heads)
    return folder


def document_rows(back: DataFrame) -> DataFrame:
    return back.select("doc_id", F.md5("text").alias("text_md5"), "source", "note")


@query(DOCUMENT_SQL)
def csv_multiline(spark: SparkSession, sf: str) -> DataFrame:
    return document_rows(read_multiline_csv(spark, document_csv(spark, sf), ["doc_id", "note", "text", "source"]))


@query(DOCUMENT_SQL)
def csv_multiline_in_splits(spark: SparkSession, sf: str) -> DataFrame:
    """The same files cut into many splits; columns by the heading. A task takes many splits, one after the other: their
    number grows with the files, and a task of its own for each would cost more than what it reads."""
    path = document_csv(spark, sf)
    small = spark.newSession()
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism * 4, size // 16_000_000)
    for key, value in (("maxPartitionBytes", "60000"), ("openCostInBytes", "60000"), ("minPartitionNum", "1"), ("maxPartitionNum", tasks)):
        small.conf.set(f"spark.sql.files.{key}", value)
    return document_rows(read_multiline_csv(small, path))


@query(
    """
    SELECT s_suppkey::VARCHAR AS employee_id, s_name AS name, 's' || s_suppkey::VARCHAR || '@example.org' AS email_address,
           n_name AS department, 'group ' || n_regionkey::VARCHAR AS user_group,
           CASE WHEN s_acctbal > 0 THEN 'active' END AS user_status, '2024-01-02' AS data_date
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
    """
)
def officer_list_load(spark: SparkSession, sf: str) -> DataFrame:
    """JSON lines with padded values in sub-folders; trimmed, dated and loaded into a table emptied before."""
    source, target = scratch_path(spark, "json"), scratch_path(spark, "officers")
    joined = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    pad = lambda c: F.concat(F.lit("  "), c, F.lit(" "))
    key = F.col("s_suppkey").cast("string")
    rows = joined.select(
        key.alias("Employee Id"),
        pad(F.col("s_name")).alias("Name"),
        pad(F.concat(F.lit("s"), key, F.lit("@example.org"))).alias("Email Address"),
        F.col("n_name").alias("Department"),
        pad(F.concat(F.lit("group "), F.col("n_regionkey").cast("string"))).alias("User Group"),
        F.when(F.col("s_acctbal") > 0, " active").alias("User Status"),
    )
    rows.withColumn("part", F.col("User Status").isNull()).write.partitionBy("part").json(source)
    back = read_json_lines(spark, source, text_schema(rows.columns))
    tables.overwrite(back.limit(0), target)
    tables.overwrite(officer_list(back, date(2024, 1, 2)), target)
    return plain(read_table(spark, target))


def write_records(df: DataFrame, path: str) -> None:
    """Metadata records as XML. Most of their text is names of elements, many times the values, so files are compressed;
    as such files are not read in splits, each holds a bounded number of records."""
    writer = df.write.format("xml").options(rowTag="metadata", rootTag="all", compression="gzip")
    writer.option("maxRecordsPerFile", 20_000).save(path)


@query(
    """
    SELECT event_id::INT AS idinfo_id, event_type AS idinfo_kind, value AS spdom_bounding_eastbc,
           event_type || ';' || props AS idinfo_keywords
    FROM events
    """
)
def xml_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "xml")
    events = table(spark, sf, "events").select(
        F.struct("event_id", F.array("event_type", "props").alias("keyword"), F.col("event_type").alias("kind")).alias("idinfo"),
        F.struct(F.struct(F.col("value").alias("eastbc")).alias("bounding")).alias("spdom"),
    )
    write_records(events, path)
    paths = [("idinfo.event_id", "int"), ("idinfo.kind", "string"), ("idinfo.keyword", "array"), ("spdom.bounding.eastbc", "double")]
    flat = flatten_paths(read_xml(spark, path, "metadata", schema_for(paths)), paths)
    return flat.select(
        F.col("idinfo_event_id").alias("idinfo_id"),
        "idinfo_kind",
        "spdom_bounding_eastbc",
        F.array_join("idinfo_keyword", ";").alias("idinfo_keywords"),
    )


@query(
    """
    SELECT event_type AS title, event_id::INT AS pubdate, value AS eastbc, NULL::DOUBLE AS westbc, NULL::VARCHAR AS direct,
           event_type || ';' || props AS placekey, 'street ' || user_id::VARCHAR AS address, user_id::INT AS postal,
           true AS passed
    FROM events
    """
)
def xml_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Metadata records with some of their elements, typed, checked and loaded."""
    source, target = scratch_path(spark, "xml"), scratch_path(spark, "metadata")
    address = F.struct(F.concat(F.lit("street "), "user_id").alias("address"), F.col("user_id").alias("postal"))
    idinfo = F.struct(
        F.struct(F.struct(F.col("event_type").alias("title"), F.col("event_id").alias("pubdate")).alias("citeinfo")).alias("citation"),
        F.struct(F.struct(F.col("value").alias("eastbc"), F.lit("unknown").alias("westbc")).alias("bounding")).alias("spdom"),
        F.struct(F.struct(F.array("event_type", "props").alias("placekey")).alias("place")).alias("keywords"),
        F.struct(F.struct(address.alias("cntaddr")).alias("cntinfo")).alias("ptcontac"),
        F.lit("not listed").alias("extra"),
    )
    events = table(spark, sf, "events").select(idinfo.alias("idinfo"))
    write_records(events, source)
    outcome = load_metadata(spark, source, target)
    found = read_table(spark, target).select(
        F.col("idinfo.citation.citeinfo.title").alias("title"),
        F.col("idinfo.citation.citeinfo.pubdate").alias("pubdate"),
        F.col("idinfo.spdom.bounding.eastbc").alias("eastbc"),
        F.col("idinfo.spdom.bounding.westbc").alias("westbc"),
        F.col("spdoinfo.direct").alias("direct"),
        F.array_join("idinfo.keywords.place.placekey", ";").alias("placekey"),
        F.col("idinfo.ptcontac.cntinfo.cntaddr.address").alias("address"),
        F.col("idinfo.ptcontac.cntinfo.cntaddr.postal").alias("postal"),
    )
    return found.crossJoin(F.broadcast(outcome.select("passed")))


def element(k: int, type: str) -> Column:
    """A value for the k-th element: some are absent, some numbers are no numbers."""
    absent = (F.col("event_id") + k) % 11 == 0
    if type == "array":
        return F.array(F.concat("event_type", F.lit(f" {k}")), "props")
    if type == "string":
        return F.when(~absent, F.concat("event_type", F.lit(f" {k}")))
    number = F.col("event_id") + k if type == "int" else F.col("value")
    return F.when(absent, "n/a").otherwise(number.cast("string"))


def element_sql(k: int, path: str, type: str) -> str:
    value = {"array": f"event_type || ' {k};' || props", "string": f"event_type || ' {k}'", "int": f"(event_id + {k})::INT", "double": "value"}[type]
    there = "" if type == "array" else f"CASE WHEN (event_id + {k}) % 11 <> 0 THEN "
    return f"{there}{value}{' END' if there else ''} AS {path.replace('.', '_')}"


@query(f"SELECT {', '.join(element_sql(k, *p) for k, p in enumerate(PATHS))} FROM events")
def xml_metadata_every_path(spark: SparkSession, sf: str) -> DataFrame:
    """Metadata records with all listed elements, loaded and told one by one."""
    source, target = scratch_path(spark, "xml"), scratch_path(spark, "metadata")

    def nested(at: str) -> Column:
        """The struct of everything below `at`."""
        below = [(k, p[len(at) :], t) for k, (p, t) in enumerate(PATHS) if p.startswith(at)]
        names = list(dict.fromkeys(p.split(".")[0] for _, p, _ in below))
        leaf = {p: element(k, t) for k, p, t in below if "." not in p}
        return F.struct(*[(leaf[n] if n in leaf else nested(f"{at}{n}.")).alias(n) for n in names])

    write_records(table(spark, sf, "events").select(nested("").alias("all")).select("all.*"), source)
    load_metadata(spark, source, target)
    flat = flatten_paths(read_table(spark, target), PATHS)
    joined = {p.replace(".", "_") for p, t in PATHS if t == "array"}
    return flat.select([F.array_join(c, ";").alias(c) if c in joined else F.col(c) for c in flat.columns])


def keyed_events(spark: SparkSession, sf: str) -> DataFrame:
    day = lambda fmt: F.date_format("ts", fmt)
    return table(spark, sf, "events").select(
        "event_id", "user_id", day("yyyy").alias("year_key"), day("yyyyMM").alias("month_key"), day("yyyyMMdd").alias("day_key")
    )


def keys_as_text(df: DataFrame) -> DataFrame:
    return df.withColumns({k: F.col(k).cast("string") for k in df.columns if k.endswith("_key") or k == "hh_mm"})


@query(
    """
    SELECT event_id, CASE WHEN strftime(ts, '%Y%m%d') >= '20240120' THEN user_id + 1000 ELSE user_id END AS user_id,
           '2024' AS year_key, '202401' AS month_key, strftime(ts, '%Y%m%d') AS day_key
    FROM events WHERE strftime(ts, '%Y%m%d') < '20240120' OR event_type <> 'error'
    """
)
def partition_replace(spark: SparkSession, sf: str) -> DataFrame:
    """Days delivered again replace themselves; the others stay."""
    path = scratch_path(spark, "days")
    events = keyed_events(spark, sf)
    tables.write_days(events, path)
    again = events.join(table(spark, sf, "events").where("event_type <> 'error'").select("event_id"), "event_id", "left_semi")
    again = only_days(again, "20240120", "20240131").withColumn("user_id", F.col("user_id") + 1000)
    tables.replace_days(again, path, files_per_day=2)
    return keys_as_text(read_table(spark, path))


@query("SELECT event_id, user_id, strftime(ts, '%Y%m%d') AS day_key FROM events WHERE ts >= DATE '2024-01-05' AND ts < DATE '2024-01-08'")
def partition_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Three days of a partitioned catalogue table; the filter picks folders."""
    path = scratch_path(spark, "days")
    name = "lakeops_" + path.rsplit("-", 1)[1]
    tables.write_days(keyed_events(spark, sf), path, files_per_day=1, table=name)
    return only_days(read_table(spark, name), "20240105", "20240107").select("event_id", "user_id", "day_key")


@query(
    """
    SELECT o_orderkey, label FROM orders
    JOIN (VALUES ('1-URGENT', 'now'), ('2-HIGH', 'soon'), ('5-LOW', NULL)) v(priority, label) ON o_orderpriority = priority
    """
)
def literal_rows_join(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with labels listed in the program."""
    labels = literal_rows(spark, [("1-URGENT", "now"), ("2-HIGH", "soon"), ("5-LOW", None)], "priority string, label string")
    orders = table(spark, sf, "orders")
    return orders.join(labels, F.col("o_orderpriority") == F.col("priority")).select("o_orderkey", "label")


@query("SELECT c_custkey, c_name, c_acctbal, 2 AS run FROM customer")
def overwrite_table(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "table")
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    for run, compression in ((1, "snappy"), (2, "uncompressed")):
        tables.overwrite(customer.withColumn("run", F.lit(run)), path, compression)
    return read_table(spark, path)


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0")
def replace_own_input(spark: SparkSession, sf: str) -> DataFrame:
    first, second = scratch_path(spark, "version"), scratch_path(spark, "version")
    view = "lakeops_" + first.rsplit("-", 1)[1]
    start = tables.replace_self(spark, table(spark, sf, "customer").select("c_custkey", "c_acctbal"), first, view)
    return tables.replace_self(spark, start.where("c_acctbal >= 0"), second, view)


@query(
    """
    SELECT c_custkey, c_acctbal, 2 AS version FROM customer WHERE c_acctbal >= 0
    UNION ALL SELECT c_custkey, c_acctbal, 1 FROM customer
    """
)
def versioned_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table replaced by what is computed from it; another session reads the new version, and the old one by its number."""
    path = scratch_path(spark, "versions")
    versions.publish(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), path)
    versions.publish(versions.read_version(spark, path).where("c_acctbal >= 0"), path)
    other = spark.newSession()
    live, first = versions.read_version(other, path), versions.read_version(other, path, 1)
    return live.withColumn("version", F.lit(2)).unionByName(first.withColumn("version", F.lit(1)))


@query(
    f"""
    WITH p AS (SELECT max(ts)::DATE AS d FROM events),
    s AS (SELECT (SELECT count(DISTINCT user_id) FROM events) AS t, count(DISTINCT user_id) AS n,
                 min(ts) AS a, max(ts) AS b FROM events, p WHERE event_type = 'purchase' AND ts::DATE = d)
    SELECT (SELECT strftime(d, '%Y-%m-%d') FROM p) AS branch_date, t AS no_of_total_branch, n AS no_of_eoc_branch,
           CASE WHEN t = n THEN 'complete' ELSE 'incomplete' END AS status, {stamp_text('a')} AS start_time,
           {stamp_text('b')} AS end_time, taken || '.000000' AS inserted_time, year_key, month_key, day_key, hh_mm
    FROM s, (VALUES ('2024-01-31 23:55:00', '2024', '202401', '20240131', '2355'),
                    ('2024-02-01 00:00:00', '2024', '202402', '20240201', '0000')) v(taken, year_key, month_key, day_key, hh_mm)
    """
)
def append_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """The close-of-day status taken twice, five minutes apart, over local midnight."""
    path = scratch_path(spark, "status")
    status = close_status(*close_tables(spark, sf), stage="purchase")
    for hour, minute in ((17, 25), (17, 30)):
        taken = datetime(2024, 1, 31, hour, minute, tzinfo=timezone.utc)
        tables.append_snapshot(stamp_snapshot(status, taken), path)
    back = read_table(spark, path).withColumn("hh_mm", F.lpad(F.col("hh_mm").cast("string"), 4, "0"))
    return plain(keys_as_text(back))


@query("SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderstatus, 1::BIGINT AS n_files FROM orders")
def single_csv_export(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "export")
    export.export_single_csv(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), path)
    return with_file_count(read_csv(spark, path))


def with_file_count(df: DataFrame) -> DataFrame:
    files = df.select(F.col("_metadata.file_name").alias("f")).agg(F.count_distinct("f").alias("n_files"))
    return df.crossJoin(F.broadcast(files))


@query("SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderstatus, (SELECT count(*) FROM orders) > 1000 AS many_files FROM orders")
def parallel_csv_export(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "export")
    export.export_csv(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), path, rows_per_file=1000)
    back = with_file_count(read_csv(spark, path))
    return back.withColumn("many_files", F.col("n_files") > 1).drop("n_files")


@query(
    """
    SELECT user_id::VARCHAR AS user_id, count(*)::VARCHAR AS n_events, strftime(ts, '%Y-%m-%d') AS data_date
    FROM events GROUP BY user_id, strftime(ts, '%Y-%m-%d')
    """
)
def csv_export_by_day(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "export")
    events = table(spark, sf, "events").withColumn("data_date", F.to_date("ts"))
    export.export_csv_by_day(events.groupBy("user_id", "data_date").agg(F.count("*").alias("n_events")), path)
    return plain(read_csv(spark, path))


@query(
    """
    SELECT '2024-01' AS payroll_month, '2023-12' AS bal_month, 'E' || c_nationkey::VARCHAR AS employer_short_code, n_name AS employer_name,
           c_custkey::VARCHAR AS employee_id, c_name AS employee_name, c_mktsegment AS channel, (c_acctbal > 0)::VARCHAR AS has_pay_adv,
           CASE WHEN c_custkey % 3 > 0 THEN 'open' END AS account_status, 'payroll_2024-01-31' AS folder, 1::BIGINT AS n_files
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    """
)
def payroll_export(spark: SparkSession, sf: str) -> DataFrame:
    """The payroll extract as one CSV under its dated name."""
    joined = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    balances = joined.select(
        F.lit("2024-01").alias("payroll_month"),
        F.lit("2023-12").alias("bal_month"),
        F.concat(F.lit("E"), "c_nationkey").alias("employer_short_code"),
        F.col("n_name").alias("employer_name"),
        F.col("c_custkey").alias("employee_id"),
        F.col("c_name").alias("employee_name"),
        F.col("c_mktsegment").alias("channel"),
        (F.col("c_acctbal") > 0).alias("has_pay_adv"),
        F.when(F.col("c_custkey") % 3 > 0, "open").alias("account_status"),
        F.lit("r").alias("cust_region"),
        F.lit(True).alias("is_bank_acc_link"),
        F.lit(1.5).alias("avgerage_balance"),
        F.lit("not extracted").alias("other"),
    )
    path = export_payroll(balances, scratch_path(spark, "exports"), date(2024, 1, 31))
    back = with_file_count(read_csv(spark, path))
    return back.drop("cust_region", "is_bank_acc_link", "avgerage_balance").withColumn("folder", F.lit(path.rsplit("/", 1)[1]))


@query(
    """
    SELECT event_id::VARCHAR AS event_id, user_id::VARCHAR AS user_id, strftime(ts, '%Y%m%d') AS day_key, 'transactions_2024-02-01' AS folder
    FROM events WHERE ts >= DATE '2024-01-10' AND ts < DATE '2024-01-21'
    """
)
def transaction_export(spark: SparkSession, sf: str) -> DataFrame:
    """Some days of a partitioned table as CSV parts under a dated name."""
    stored = scratch_path(spark, "days")
    tables.write_days(keyed_events(spark, sf), stored)
    path = export_transactions(spark, stored, "20240110", "20240120", scratch_path(spark, "exports"), date(2024, 2, 1), rows_per_file=500)
    return read_csv(spark, path).select("event_id", "user_id", "day_key", F.lit(path.rsplit("/", 1)[1]).alias("folder"))


def half_year(fmt: str, shift: int = 0) -> Column:
    start = F.when(F.month("o_orderdate") > 6, F.make_date(F.year("o_orderdate"), F.lit(7), F.lit(1))).otherwise(
        F.trunc("o_orderdate", "year")
    )
    return F.date_format(F.date_add(start.cast("date"), shift), fmt)


HALF_SQL = "make_date(year(o_orderdate), CASE WHEN month(o_orderdate) > 6 THEN 7 ELSE 1 END, 1)"
KEYS_SQL = "strftime({d}, '%Y') AS year_key, strftime({d}, '%Y%m') AS month_key, strftime({d}, '%Y%m%d') AS day_key"


def category(level: int, modulus: int) -> list[Column]:
    return [(F.col("o_custkey") % modulus).cast("string"), F.concat(F.lit("name, "), F.col("o_orderpriority"))]


HEADLESS = "z_category_18991231.csv"
HEADINGS = ["Level 1 Category Id", "Level 1 Category Name", "Level 2 Category Id", "Level 2 Category Name", "Level 3 Category Id", "Level 3 Category Name"]
HEADINGS += ["Created User Id", "Created Date", "Status", "Updated User Id", "Last Updated Date"]


def category_files(spark: SparkSession, sf: str, folder: str) -> None:
    """Two files per half-year, of which the one greater in name counts; bad stamps. In files of the second half of a
    year columns stand in another order, one is spelt otherwise, and a new one has a heading of 70,000 characters. One
    more file, with a copy of all rows, has no date in its name."""
    key = F.col("o_orderkey")
    orders = table(spark, sf, "orders")
    cells = dict(zip(HEADINGS, [
        *[c for level, m in ((1, 5), (2, 25), (3, 1000)) for c in category(level, m)],
        key.cast("string"),
        F.when(key % 10 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")),
        F.col("o_orderstatus"),
        F.when(key % 3 != 0, "u1"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
    ], strict=True))
    rows = orders.select(
        *[c.alias(h) for h, c in cells.items()],
        F.explode(F.array(F.lit("a"), F.lit("b"), F.lit("x"))).alias("version"),
        half_year("yyyyMMdd").alias("half"),
    )
    rows = rows.withColumn("Status", F.when(F.col("version") == "a", "old").otherwise(F.col("Status")))
    dated = F.concat("version", F.lit("_category_"), "half", F.lit(".csv"))
    rows = rows.withColumn("_file", F.when(F.col("version") == "x", "x_undated.csv").otherwise(dated))
    later = F.col("half").endswith("0701") & (F.col("version") != "x")
    csv = lambda names: F.concat_ws(",", *[F.coalesce(quoted_cell(F.col(n)), F.lit("")) for n in names])
    turned = HEADINGS[::-1]
    lines = rows.select("_file", later.alias("_later"), F.when(later, F.concat(F.lit("new,"), csv(turned))).otherwise(csv(HEADINGS)).alias("value"))
    spelt = ",".join(["n" * 70_000, *[h.replace("Created Date", "created_date") for h in turned]])
    heads = lines.select("_file", "_later").distinct().select(F.lit(-1).cast("long").alias("_order"), "_file", F.when(F.col("_later"), spelt).otherwise(",".join(HEADINGS)).alias("value"))
    # blank lines before some headings, and a file without a heading
    blank = heads.where("_file LIKE 'b%'").select(F.lit(-2).cast("long").alias("_order"), "_file", F.lit(" ").alias("value"))
    headless = literal_rows(spark, [(0, HEADLESS, "1,name,2,name"), (1, HEADLESS, "")], "_order long, _file string, value string")
    heads = heads.unionByName(blank).unionByName(headless)
    write_named(lines.drop("_later"), folder, "_file", lambda writer, path: writer.text(path), heads)


CATEGORY_SQL = f"""
    SELECT (o_custkey % 5)::VARCHAR AS level_1_category_id, 'name, ' || o_orderpriority AS level_1_category_name,
           (o_custkey % 25)::VARCHAR AS level_2_category_id, 'name, ' || o_orderpriority AS level_2_category_name,
           (o_custkey % 1000)::VARCHAR AS level_3_category_id, 'name, ' || o_orderpriority AS level_3_category_name,
           o_orderkey::VARCHAR AS created_user_id,
           CASE WHEN o_orderkey % 10 <> 0 THEN {stamp_text('o_orderdate')} END AS created_date, o_orderstatus AS status,
           CASE WHEN o_orderkey % 3 <> 0 THEN 'u1' END AS updated_user_id, {stamp_text('o_orderdate')} AS last_updated_date,
           'b_category_' || strftime({HALF_SQL}, '%Y%m%d') || '.csv' AS file_name, {KEYS_SQL.format(d='h')}
    FROM (SELECT *, {HALF_SQL} - INTERVAL 1 DAY AS h FROM orders)
"""


@query(CATEGORY_SQL)
def ingest_folder(spark: SparkSession, sf: str) -> DataFrame:
    """Dated CSV files into a partitioned table, twice; a file without a date is left out."""
    source, target = scratch_path(spark, "source"), scratch_path(spark, "categories")
    category_files(spark, sf, source)
    for _ in range(2):
        ingest(spark, CATEGORIES, source, target)
    return plain(keys_as_text(read_table(spark, target)))


ASIDE_SQL = f"""
    SELECT 'x_undated.csv' AS file_name, 'undated' AS what, 1::BIGINT AS n
    UNION ALL
    SELECT '{HEADLESS}', 'headless', 1
    UNION ALL
    SELECT 'b_category_' || strftime({HALF_SQL}, '%Y%m%d') || '.csv', 'created_date', count(*) FROM orders WHERE o_orderkey % 10 = 0 GROUP BY 1
"""


def told_aside(spark: SparkSession, target: str) -> DataFrame:
    """What an ingest set aside: files without a date or heading, and cells per file and column that did not fit."""
    files = lambda what: read_table(spark, aside(target, what)).select("file_name", F.lit(what).alias("what"), F.lit(1).cast("long").alias("n"))
    return files("undated").unionByName(files("headless")).unionByName(read_table(spark, aside(target, "unparsed")).select("file_name", F.col("column").alias("what"), "n"))


@query(ASIDE_SQL)
def ingest_aside(spark: SparkSession, sf: str) -> DataFrame:
    source, target = scratch_path(spark, "source"), scratch_path(spark, "categories")
    category_files(spark, sf, source)
    ingest(spark, CATEGORIES, source, target)
    return told_aside(spark, target)


@query(
    f"""
    SELECT 'b_category_' || strftime(h, '%Y%m%d') || '.csv' AS file_name, strftime(h - INTERVAL 1 DAY, '%Y%m%d') AS day_key, 'taken' AS state, count(*) AS n_rows
    FROM (SELECT {HALF_SQL} AS h FROM orders) GROUP BY h
    UNION ALL
    SELECT DISTINCT 'a_category_' || strftime(h, '%Y%m%d') || '.csv', strftime(h - INTERVAL 1 DAY, '%Y%m%d'), 'superseded', NULL::BIGINT
    FROM (SELECT {HALF_SQL} AS h FROM orders)
    UNION ALL SELECT 'x_undated.csv', NULL, 'undated', NULL
    UNION ALL SELECT '{HEADLESS}', '18991230', 'headless', 0
    """
)
def ingest_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """What became of each file, and how many rows the write counted for it, after two loads."""
    source, target = scratch_path(spark, "source"), scratch_path(spark, "categories")
    category_files(spark, sf, source)
    for _ in range(2):
        ingest(spark, CATEGORIES, source, target)
    return read_table(spark, aside(target, "files")).select("file_name", "day_key", "state", "n_rows")


LOGIN_SQL = f"""
    SELECT (100000 + o_orderkey)::VARCHAR AS customer_id, '09' || o_custkey::VARCHAR AS phone_number,
           CASE o_orderkey % 4 WHEN 0 THEN 'Ann Lee' WHEN 3 THEN 'Hal' ELSE 'Bob Ray' END AS customer_name,
           CASE WHEN o_orderkey % 4 <> 3 THEN {stamp_text('o_orderdate')} END AS login_time,
           NULL::VARCHAR AS source, NULL::VARCHAR AS role,
           'logins_' || strftime({HALF_SQL}, '%Y%m%d') || '.csv' AS file_name, {KEYS_SQL.format(d='h')}
    FROM (SELECT *, {HALF_SQL} - INTERVAL 1 DAY AS h FROM orders)
"""


def login_files(spark: SparkSession, sf: str, folder: str) -> None:
    """Raw login logs, one file per half-year, with commas and line breaks in names and rows cut short."""
    kind, stamp = F.col("o_orderkey") % 4, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    start = F.concat_ws(",", (F.col("o_orderkey") + 100000).cast("string"), F.concat(F.lit("09"), "o_custkey"))
    line = (
        F.when(kind == 0, F.concat_ws(",", start, F.lit("Ann Lee"), stamp))
        .when(kind == 1, F.concat_ws(",", start, F.lit("Bob\nRay"), stamp))
        .when(kind == 2, F.concat_ws(",", start, F.lit("Bob,Ray"), stamp))
        .otherwise(F.concat_ws(",", start, F.lit("Hal")))
    )
    name = F.concat(F.lit("logins_"), half_year("yyyyMMdd"), F.lit(".csv"))
    lines = table(spark, sf, "orders").select(line.alias("value"), name.alias("_file"))
    write_named(lines, folder, "_file", lambda writer, path: writer.text(path))


@query(LOGIN_SQL)
def ingest_login_log(spark: SparkSession, sf: str) -> DataFrame:
    """Raw login logs repaired and typed into a partitioned table."""
    source, target = scratch_path(spark, "source"), scratch_path(spark, "logins")
    login_files(spark, sf, source)
    ingest(spark, LOGINS, source, target)
    return plain(keys_as_text(read_table(spark, target)))


@query(
    f"""
    SELECT strftime({HALF_SQL}, '%Y-%m-%d') AS datadate, 'c' || o_orderkey::VARCHAR AS center_code,
           o_orderstatus || ' state' AS state_of_pay_center, 'say "hi" twice' AS remark, NULL::VARCHAR AS org_name,
           year({HALF_SQL})::INT AS year_key, strftime({HALF_SQL}, '%Y%m')::INT AS month_key,
           strftime({HALF_SQL}, '%Y%m%d')::INT AS day_key
    FROM orders
    """
)
def ingest_center_list(spark: SparkSession, sf: str) -> DataFrame:
    """Files with line breaks and quotes in cells, a blank first heading and a heading broken over two lines."""
    source, target = scratch_path(spark, "source"), scratch_path(spark, "centers")
    rows = table(spark, sf, "orders").select(
        F.concat(F.lit(" c"), F.col("o_orderkey").cast("string")).alias(" "),
        F.concat("o_orderstatus", F.lit("\n  state ")).alias("State_of\n_pay_center "),
        F.lit('say "hi"  \n twice').alias("Remark"),
        F.concat(F.lit("list_"), half_year("yyyy-MM-dd"), F.lit(".csv")).alias("_file"),
    )
    write_named(rows, source, "_file", lambda writer, path: as_csv(writer.option("escape", '"').option("quoteAll", True), path))
    ingest(spark, centers("pay"), source, target)
    wanted = ["datadate", "center_code", "state_of_pay_center", "remark", "org_name", *tables.KEYS]
    return read_table(spark, target).select(wanted)

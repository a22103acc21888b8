"""Folders, replaced days, exports."""

import pytest
from pyspark.sql import functions as F

from lakeops.functions.names import drop_spill
from lakeops.operators.upsert import upsert_day
from lakeops.plans.feeds import CUSTOMERS, aside, centers, ingest, read_rows
from lakeops.plans.metadata import PATHS
from lakeops.sinks.export import export_csv_by_day, export_single_csv
from lakeops.sinks.tables import replace_days, write_buckets, write_days
from lakeops.operators.mapping import schema_for
from lakeops.sources.files import read_csv, read_multiline_csv, read_raw_lines, read_xml
from lakeops.sources.folder import Naming, latest_per_day, list_files, only_days, undated
from lakeops.streaming.ingest import ingest_new_files
from pyspark.sql import DataFrameWriter

from suite import storage
from suite.storage import write_named


def test_listing(spark, tmp_path):
    sub = tmp_path / "in" / "sub"
    sub.mkdir(parents=True)
    for name in ("a_20240102.csv", "b_20240102.csv", "c_20240103.csv", "c_20249999.csv", "skip_20240104.csv", "d_20240105.txt"):
        (sub / name).write_text("x\n")
    naming = Naming(glob="*.csv", skip=("skip_20240104.csv",))
    files = list_files(spark, str(tmp_path / "in"), naming)
    latest = {r["file_name"]: r["day_key"] for r in latest_per_day(files).collect()}
    assert latest == {"b_20240102.csv": "20240101", "c_20240103.csv": "20240102"}
    assert [r["file_name"] for r in undated(files).collect()] == ["c_20249999.csv"]


def test_ingest_twice_is_ingest_once(spark, tmp_path):
    source, table = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "x_02012024.csv").write_text("phone no,level\n09,A\n09,B\n")
    (source / "x_03012024.csv").write_text("phone no,level\n09,C\n")
    ingest(spark, CUSTOMERS, str(source), table)
    (source / "y_03012024.csv").write_text("phone no,level\n08,D\n")
    for _ in range(2):
        ingest(spark, CUSTOMERS, str(source), table)
    got = sorted((str(r["day_key"]), r["level"]) for r in spark.read.parquet(table).collect())
    assert got == [("20240101", "A"), ("20240101", "B"), ("20240102", "D")]


def test_files_with_other_headings(spark, tmp_path):
    source, table = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "x_02012024.csv").write_text("phone no,level,status\n09,A,on\n")
    (source / "x_03012024.csv").write_text("status,trust_level,phone no\noff,B,08\n")
    (source / "x_04012024.csv").write_text("trust_level,new column\nC,?\n")
    (source / "x_05012024.csv").write_text("phone no,level,status\n07,D,on\n")
    (source / "x_06012024.csv").write_text("")
    ingest(spark, CUSTOMERS, str(source), table)
    got = sorted((r["level"], r["phone_no"], r["status"]) for r in spark.read.parquet(table).collect())
    assert got == [("A", "09", "on"), ("B", "08", "off"), ("C", None, None), ("D", "07", "on")]


def test_headings_that_differ_behind_a_long_column(spark, tmp_path):
    source, table = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    long = "n" * 70_000
    (source / "x_02012024.csv").write_text(f"{long},phone no,level\n?,09,A\n")
    (source / "x_03012024.csv").write_text(f"{long},level,phone no\n?,B,08\n")
    (source / "bad_99999999.csv").write_text("phone no\n1\n")
    ingest(spark, CUSTOMERS, str(source), table)
    assert sorted((r["level"], r["phone_no"]) for r in spark.read.parquet(table).collect()) == [("A", "09"), ("B", "08")]
    assert [r["file_name"] for r in spark.read.parquet(aside(table, "undated")).collect()] == ["bad_99999999.csv"]


def test_heading_over_lines_and_compressed(spark, tmp_path):
    import gzip

    (tmp_path / "a.csv.gz").write_bytes(gzip.compress(b'"first\nname","b ""x"""\n1,2\n'))
    df = read_multiline_csv(spark, str(tmp_path / "a.csv.gz"))
    assert df.columns == ["first\nname", 'b "x"', "file_name"]
    assert [tuple(r)[:2] for r in df.collect()] == [("1", "2")]


@pytest.mark.parametrize("per_batch", [1, 2, None])
def test_stream_equals_batch(spark, tmp_path, per_batch):
    source, table, other = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "batch")
    source.mkdir()
    names = ("b_02012024.csv", "a_02012024.csv", "c_03012024.csv", "x_undated.csv")
    texts = ("phone no,level\n09,B\n", "level,phone no\nA,09\n", "trust_level,phone no,date registered\nC,07,soon\n", "level\nU\n")
    for name, text in zip(names, texts, strict=True):
        (source / name).write_text(text)
        if per_batch == 1:
            ingest_new_files(spark, CUSTOMERS, str(source), table, str(tmp_path / "progress"))
    ingest_new_files(spark, CUSTOMERS, str(source), table, str(tmp_path / "progress"), per_batch)
    ingest(spark, CUSTOMERS, str(source), other)
    rows = lambda path: sorted((str(r["day_key"]), r["level"], r["phone_no"], r["file_name"]) for r in spark.read.parquet(path).collect())
    assert rows(table) == rows(other) == [("20240101", "B", "09", "b_02012024.csv"), ("20240102", "C", "07", "c_03012024.csv")]
    for what in ("undated", "unparsed"):
        told = spark.read.parquet(aside(table, what)).drop("batch")
        assert told.distinct().collect() == spark.read.parquet(aside(other, what)).select(told.columns).collect()


def test_blank_lines_before_the_heading_and_files_without_one(spark, tmp_path):
    source, table = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "x_02012024.csv").write_text("\n  \r\nphone no,level\n\n09,A\n")
    (source / "x_03012024.csv").write_text("phone no,level,date registered\n08,B,soon\n07,C,2024/01/02 10:00:00\n")
    (source / "blank_04012024.csv").write_text("\n\n")
    (source / "none_05012024.csv").write_text("06,D\n05,E\n")
    (source / "a_03012024.csv").write_text("phone no\n1\n")
    ingest(spark, CUSTOMERS, str(source), table)
    ingest_new_files(spark, CUSTOMERS, str(source), str(tmp_path / "streamed"), str(tmp_path / "progress"), 2)
    for path in (table, str(tmp_path / "streamed")):
        assert sorted((r["phone_no"], r["level"]) for r in spark.read.parquet(path).collect()) == [("07", "C"), ("08", "B"), ("09", "A")]
        ledger = {r["file_name"]: (r["state"], r["n_rows"]) for r in spark.read.parquet(aside(path, "files")).collect()}
        want = {"x_02012024.csv": ("taken", 1), "x_03012024.csv": ("taken", 2), "blank_04012024.csv": ("headless", 0), "none_05012024.csv": ("headless", 0)}
        # a stream may take the lesser file of a day first, and the greater one in a later batch
        assert ledger.pop("a_03012024.csv")[0] in ("superseded", "taken") and ledger == want
        assert {r["file_name"] for r in spark.read.parquet(aside(path, "headless")).collect()} == {"blank_04012024.csv", "none_05012024.csv"}
        assert [tuple(r)[:3] for r in spark.read.parquet(aside(path, "unparsed")).collect()] == [("x_03012024.csv", "date_registered", 1)]


def test_ingest_scans_the_text_twice(spark, tmp_path):
    """By the plans of all that is written on the way."""
    source, table = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "x_02012024.csv").write_text("phone no,date registered\n09,A\n")
    scans = []
    plain = DataFrameWriter.parquet

    def told(self, *args, **kwargs):
        scans.append(self._df._jdf.queryExecution().executedPlan().toString().count("FileScan text"))
        return plain(self, *args, **kwargs)

    DataFrameWriter.parquet = told
    try:
        ingest(spark, CUSTOMERS, str(source), table)
    finally:
        DataFrameWriter.parquet = plain
    assert sum(scans) == 2


def test_replace_days_and_pruning(spark, tmp_path):
    path = str(tmp_path / "t")
    keys = {"year_key": F.lit("2024"), "month_key": F.lit("202401"), "day_key": F.concat(F.lit("2024010"), F.col("id") % 3)}
    df = spark.range(30).withColumns(keys)
    write_days(df, path)
    replace_days(df.where("day_key = '20240101' AND id < 10"), path, files_per_day=3)
    back = spark.read.parquet(path)
    counts = {str(r["day_key"]): r["count"] for r in back.groupBy("day_key").count().collect()}
    assert counts == {"20240100": 10, "20240101": 3, "20240102": 10}
    plan = only_days(back, "20240102")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day_key" in plan


def test_exports_are_what_was_asked(spark, tmp_path):
    df = spark.range(100, numPartitions=7).select("id", (F.col("id") % 2).alias("data_date"))
    export_single_csv(df, str(tmp_path / "one"))
    export_csv_by_day(df, str(tmp_path / "days"))
    assert len(list((tmp_path / "one").glob("*.csv"))) == 1
    assert [len(list(d.glob("*.csv"))) for d in (tmp_path / "days").glob("data_date=*")] == [1, 1]
    for name in ("one", "days"):
        assert read_csv(spark, str(tmp_path / name)).count() == 100


def test_days_are_rebalanced(spark, tmp_path):
    keys = {"year_key": F.lit("2024"), "month_key": F.lit("202401"), "day_key": (F.col("id") % 3).cast("string")}
    write_days(spark.range(3000, numPartitions=8).withColumns(keys), str(tmp_path / "t"))
    assert len(list((tmp_path / "t").rglob("*.parquet"))) <= 6


def test_spill_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b,,\n1,2,3,4\n")
    df = read_csv(spark, str(tmp_path / "a.csv"))
    assert drop_spill(df, 2).columns == ["a", "b"]


def test_bucketed_base_is_not_shuffled(spark, tmp_path):
    base = spark.range(1000).select("id", F.lit("A").alias("status"), F.lit(0).alias("at"))
    write_buckets(base, str(tmp_path / "b"), "bucketed_base", ("id",), 4)
    stored = spark.table("bucketed_base")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = base.where("id < 10").withColumns({"status": F.lit("B"), "at": F.lit(1)})
        result = upsert_day(stored, new, ["id"], "status", ["id", "status"])
        counts = {r["status"]: r["count"] for r in result.groupBy("status").count().collect()}
        plan = result._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert counts == {"A": 990, "B": 10}
    scans = [i for i, line in enumerate(plan.split("\n")) if "FileScan parquet" in line and "Bucketed: true" in line]
    assert len(scans) == 2
    assert not any("Exchange" in line for i in scans for line in plan.split("\n")[i - 4 : i])
    spark.sql("DROP TABLE bucketed_base")


def test_metadata_paths():
    assert len(PATHS) == 70 == len({p for p, _ in PATHS})
    assert [t for _, t in PATHS].count("int") == 6 and [t for _, t in PATHS].count("double") == 4
    assert [t for _, t in PATHS].count("array") == 4


def test_named_files_are_dealt_to_many_tasks_before_they_are_written(spark, tmp_path):
    folder = str(tmp_path / "named")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000")
    try:
        rows = spark.range(20_000).select(F.col("id").cast("string").alias("value"), F.lit("a.csv").alias("_file"))
        heads = spark.createDataFrame([(-1, "name", "a.csv"), (-2, "", "a.csv"), (-1, "alone", "b.csv")], "_order long, value string, _file string")
        write_named(rows, folder, "_file", lambda writer, path: writer.text(path), heads)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "named-rows" / "_file=a.csv").glob("part-*"))) > 1
    lines = (tmp_path / "named" / "a.csv").read_text().splitlines()
    assert lines[:2] == ["", "name"] and sorted(map(int, lines[2:])) == list(range(20_000))
    assert (tmp_path / "named" / "b.csv").read_text() == "alone\n"


def test_many_small_splits_share_tasks(spark, tmp_path, monkeypatch):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit('word "q"\n'), 400).alias("text"), F.lit("s").alias("source"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    read = []
    monkeypatch.setattr(storage, "read_multiline_csv", lambda session, path: read.append(read_raw_lines(session, path)) or read_multiline_csv(session, path))
    back = storage.csv_multiline_in_splits(spark, str(tmp_path))
    assert back.count() == 3000 and back.select("text_md5").distinct().count() == 1
    splits = read[0].select("file_path", "block").distinct().count()
    assert splits > 150 and read[0].rdd.getNumPartitions() < 60


def test_metadata_records_are_compressed_in_bounded_files(spark, tmp_path):
    records = spark.range(25_000).coalesce(1).select(F.struct("id", F.lit("x" * 300).alias("title")).alias("idinfo"))
    storage.write_records(records, f"{tmp_path}/xml")
    files = list((tmp_path / "xml").glob("part-*.gz"))
    assert len(files) == 2 and sum(f.stat().st_size for f in files) < 1_000_000
    back = read_xml(spark, f"{tmp_path}/xml", "metadata", schema_for([("idinfo.id", "string")]))
    assert sorted(int(r[0]) for r in back.select("idinfo.id").collect()) == list(range(25_000))


def test_records_of_a_list_are_put_together_once(spark, tmp_path):
    (tmp_path / "list_2024-01-02.csv").write_text('"","State_of\n_pay_center "\n"c1","on\n  hold"\n')
    rows, _ = read_rows(spark, centers("pay"), [str(tmp_path / "list_2024-01-02.csv")])
    assert "FileScan text" not in rows._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in rows.select("center_code", "state_of_pay_center").collect()] == [("c1", "on hold")]

"""Readers. Raw files are read as strings; types come from the mapping step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakeops.functions.names import distinct_names
from lakeops.session import materialize
from lakeops.sources.delimited import cells_of, quoted_records

Paths = str | list[str]


def text_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def read_csv(
    spark: SparkSession, paths: Paths, columns: Sequence[str] | None = None, sep: str = ",", quote: str = '"'
) -> DataFrame:
    """CSV with a heading line, every column a string. Known `columns` save the look at the heading.

    Columns are taken by position then; files whose headings differ should be read without `columns`.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("quote", quote)
    if columns is not None:
        reader = reader.schema(text_schema(columns)).option("enforceSchema", True)
    return reader.csv(paths)


def read_multiline_csv(spark: SparkSession, paths: Paths, columns: Sequence[str] | None = None, sep: str = ",") -> DataFrame:
    """CSV whose quoted cells may hold line breaks and doubled quotes, every column a string, and `file_name`.

    Files of all sizes are read in splits (see `sources.delimited`). Columns go by position; without `columns` they
    are called as in the first file.
    """
    records = quoted_records(read_raw_lines(spark, paths), sep)
    cells = F.col("_cells")
    if columns is None:  # records are put together once, for the heading and for the rows
        records = materialize(records, "records")
        first = records.where("is_first").orderBy("file_path").select(cells_of(F.col("record"), sep)).first()
        columns = distinct_names([c or f"_c{i}" for i, c in enumerate(first[0])]) if first else []
    rows = records.where(~F.col("is_first") & (F.trim("record") != "")).select(cells_of(F.col("record"), sep).alias("_cells"), "file_name")
    return rows.select(*[F.get(cells, F.lit(i)).alias(c) for i, c in enumerate(columns)], "file_name")


def pin_splits(spark: SparkSession) -> None:
    """Fix the least number of splits at its present value, where the session was not built with one.

    Left alone it follows the number of cores, so while executors come and go two scans of one plan could split a small
    file differently. Operators that number lines per split need the same splits in all scans.
    """
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))


def read_lines(spark: SparkSession, paths: Paths) -> DataFrame:
    """Raw lines with the file and the split they come from: value, file_path, file_name, block."""
    pin_splits(spark)
    return with_place(spark.read.text(paths))


def read_raw_lines(spark: SparkSession, paths: Paths) -> DataFrame:
    """As `read_lines`, but lines end with a line feed only; a carriage return is part of the text."""
    pin_splits(spark)
    return with_place(spark.read.option("lineSep", "\n").text(paths))


def with_place(lines: DataFrame) -> DataFrame:
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def read_json_lines(spark: SparkSession, paths: Paths, schema) -> DataFrame:
    """One JSON object per line, sub-folders included. Pass a schema: inference reads everything twice."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).json(paths)


def read_xml(spark: SparkSession, paths: Paths, row_tag: str, schema=None) -> DataFrame:
    reader = spark.read.format("xml").option("rowTag", row_tag)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(paths)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalogue table, or a Parquet folder when the name holds a slash."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    split_on: str | None = None,
    bounds: tuple[str, str] | None = None,
    parts: int = 1,
    **options: str,
) -> DataFrame:
    """A database table. With `split_on` the scan runs as `parts` range queries; filters reach the database."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if split_on is not None:
        if bounds is None:
            raise ValueError("a split scan needs bounds")
        reader = reader.option("partitionColumn", split_on).option("numPartitions", parts)
        reader = reader.option("lowerBound", bounds[0]).option("upperBound", bounds[1])
    return reader.load()


def read_excel(
    spark: SparkSession, paths: Paths, columns: Sequence[str], date_columns: Sequence[str] = ()
) -> DataFrame:
    """One workbook per task; strings except `date_columns`; an empty cell is NULL. Needs openpyxl on the workers."""
    columns, dates = list(columns), set(date_columns)
    schema = StructType([StructField("file_name", StringType()), *text_schema(columns)])
    files = spark.read.format("binaryFile").load(paths).select("_metadata.file_name", "content")

    def decode(batches):
        import io

        import pandas as pd

        for batch in batches:
            for name, content in zip(batch["file_name"], batch["content"]):
                sheet = pd.read_excel(io.BytesIO(content), engine="openpyxl")
                sheet.columns = [str(c) for c in sheet.columns]
                sheet = sheet.reindex(columns=columns)
                for c in columns:
                    if c in dates:
                        sheet[c] = pd.to_datetime(sheet[c], errors="coerce").dt.strftime("%Y-%m-%d")
                    else:
                        sheet[c] = sheet[c].map(lambda v: None if pd.isna(v) else str(v))
                sheet = sheet.astype(object).where(sheet.notna(), None)
                sheet.insert(0, "file_name", name)
                yield sheet

    rows = files.mapInPandas(decode, schema)
    return rows.withColumns({c: F.try_to_date(F.col(c), "yyyy-MM-dd") for c in columns if c in dates})


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)

"""CSV exports for consumers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lakeops.sinks.tables import spread

def export_csv(df: DataFrame, path: str, rows_per_file: int | None = None) -> None:
    """CSV parts with a heading each, written where the rows are."""
    writer = df.write.mode("overwrite").option("header", True)
    if rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.csv(path)


def export_single_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a heading, whatever the size, for a consumer who takes one file.

    The result is computed in parallel; only writing it out is one task's work, row by row. For a result that no single
    file should hold, use `export_csv`.
    """
    df.repartition(1).write.mode("overwrite").option("header", True).csv(path)


def export_csv_by_day(df: DataFrame, path: str, day: str = "data_date") -> None:
    """One folder per day with one CSV each, all days in one job."""
    spread(df, (day,), 1).write.mode("overwrite").option("header", True).partitionBy(day).csv(path)

"""Folders of dated files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeops.functions.dates import date_keys, file_day


@dataclass(frozen=True)
class Naming:
    """How a family of files is named and which day it stands for.

    `pattern` finds the date in the name (one group, or one each for year, month, day); `fmt` reads it; the keys are
    those of the day `shift` days later.
    """

    pattern: str = r"(\d{8})\.[^.]*$"
    fmt: str = "yyyyMMdd"
    shift: int = -1
    as_int: bool = False
    glob: str = "*"
    skip: tuple[str, ...] = ()


def stamp_keys(df: DataFrame, naming: Naming, name: str = "file_name") -> DataFrame:
    """Add year_key, month_key, day_key from a file name column; NULL keys for a name without a date."""
    return df.withColumns(date_keys(file_day(F.col(name), naming.pattern, naming.fmt), naming.shift, as_int=naming.as_int))


def list_files(spark: SparkSession, folder: str, naming: Naming) -> DataFrame:
    """All files of the family below `folder`: file_path, file_name, keys. Contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", naming.glob)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select(F.col("path").alias("file_path"), F.element_at(F.split("path", "/"), -1).alias("file_name"))
    )
    if naming.skip:
        files = files.where(~F.col("file_name").isin(*naming.skip))
    return stamp_keys(files, naming)


def latest_per_day(files: DataFrame) -> DataFrame:
    """One file per day, the one with the greatest name: a reload replaces what was delivered before."""
    order = W.partitionBy("day_key").orderBy(F.col("file_name").desc(), F.col("file_path").desc())
    dated = files.where(F.col("day_key").isNotNull())
    return dated.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def undated(files: DataFrame) -> DataFrame:
    """Files set aside because their name holds no valid date."""
    return files.where(F.col("day_key").isNull()).select("file_path", "file_name")


def paths_of(files: DataFrame) -> list[str]:
    """The file paths, as input to a reader: the list Spark's driver holds for any scan of these files."""
    return [r[0] for r in files.select("file_path").collect()]


def only_days(df: DataFrame, first: str, last: str | None = None, key: str = "day_key") -> DataFrame:
    """Partitions first..last of a dated table; the filter prunes folders."""
    return df.where(F.col(key) == first) if last is None else df.where(F.col(key).between(first, last))

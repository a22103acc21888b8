"""Collects the queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its own name."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, so that engines agree on them."""

    def text(f):
        if isinstance(f.dataType, DateType):
            return F.date_format(f.name, "yyyy-MM-dd").alias(f.name)
        if isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            return F.date_format(f.name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(f.name)
        return F.col(f.name)

    return df.select([text(f) for f in df.schema.fields])


def day_text(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def stamp_text(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"

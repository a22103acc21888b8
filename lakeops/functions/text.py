"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed value: how a login stamp is written.
STAMP = r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}"


def one_line(c: Column) -> Column:
    """Trimmed, with every run of white space, line breaks included, as one space."""
    return F.regexp_replace(F.trim(c), r"\s+", " ")


def strip_quotes(c: Column) -> Column:
    return F.replace(c, F.lit('"'), F.lit(""))


def is_stamp(c: Column) -> Column:
    return c.rlike(f"^{STAMP}$")


def has_stamp(c: Column) -> Column:
    return c.rlike(STAMP)


def ends_with_stamp(c: Column) -> Column:
    return F.trim(c).rlike(f"{STAMP}$")


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def each_string(df: DataFrame, fn, columns: list[str] | None = None) -> DataFrame:
    """`fn` applied to every string column (or those listed), in one projection."""
    chosen = set(string_columns(df) if columns is None else columns)
    return df.select([fn(quoted(c)).alias(c) if c in chosen else quoted(c) for c in df.columns])


def blanks_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return each_string(df, blank_to_null, columns)


def quoted(name: str) -> Column:
    """A top-level column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")

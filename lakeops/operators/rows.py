"""Joins, filters and deletes shared by the larger operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.text import quoted


def join_on(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", null_safe: bool = False
) -> DataFrame:
    """Equi-join on like-named columns, keeping the left ones. `null_safe`: NULL equals NULL.

    The right ones are renamed first, so frames made from each other can be joined.
    """
    other = {c: f"_r_{c}" for c in on}
    condition = F.lit(True)
    for mine, theirs in other.items():
        a, b = quoted(mine), quoted(theirs)
        condition = condition & (a.eqNullSafe(b) if null_safe else a == b)
    return left.join(right.withColumnsRenamed(other), condition, how).drop(*other.values())


def at_latest(df: DataFrame, column: str, of: DataFrame | None = None, of_column: str | None = None) -> DataFrame:
    """Rows at the greatest value of a column, their own or another table's.

    The value is a scalar subquery, so on a partition column it also decides which folders are read.
    """
    source, name = (df, column) if of is None else (of, of_column or column)
    return df.where(F.col(column) == source.agg(F.max(name)).scalar())


def beside(left: DataFrame, one_row: DataFrame, emit_zero: bool = False) -> DataFrame:
    """`left` with the columns of a frame of no more than one row. When that is empty the result is empty too, or with
    `emit_zero` has NULLs.

    The frame is brought to one row by an aggregate that fails when it finds a second, so what is sent to all tasks is
    one row by construction.
    """
    many = F.assert_true(F.count("*") <= 1, F.lit("beside needs a frame of no more than one row"))
    row = F.struct(*[quoted(c) for c in one_row.columns])
    found = one_row.select(row.alias("_row")).agg(F.first("_row").alias("_row"), F.count("*").alias("_n"), many.alias("_checked"))
    found = found.where(F.col("_checked").isNull())
    found = found if emit_zero else found.where("_n > 0")
    columns = [F.col("_row")[c].alias(c) for c in one_row.columns]
    return left.crossJoin(F.broadcast(found.select(*columns)))


def keys_of(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys without NULL parts, as a side for semi and anti joins."""
    return df.select(*keys).dropna().distinct()


def delete_matching(base: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Base rows whose keys are not in `gone`. A key with a NULL part matches nothing and stays."""
    return base.join(keys_of(gone, keys), list(keys), "left_anti")


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """As SQL DELETE: a row goes when the condition is true, not when it is NULL."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def any_row(df: DataFrame, condition: Column, name: str = "found") -> DataFrame:
    """One row, one Boolean: is there a row meeting the condition? Stops at the first one found."""
    return df.where(condition).limit(1).agg((F.count("*") > 0).alias(name))


def status_gate(status: DataFrame, day: Column, op: str = ">=", done: str = "complete") -> DataFrame:
    """Is a finished status there, dated on or after (`>=`), exactly on (`==`) or before (`<`) `day`?"""
    at = F.col("branch_date")
    dated = {">=": at >= day, "==": at == day, "<": at < day}[op]
    return any_row(status, (F.col("status") == done) & dated, "is_open")

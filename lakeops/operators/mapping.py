"""Renaming, typing and projecting columns from a declared list."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from lakeops.functions.text import quoted


@dataclass(frozen=True)
class Field:
    """One target column: accepted source spellings in order of preference, target name, type, and for dates and
    timestamps the text format."""

    sources: str | tuple[str, ...]
    target: str
    type: str = "string"
    fmt: str | None = None

    @property
    def spellings(self) -> tuple[str, ...]:
        return (self.sources,) if isinstance(self.sources, str) else self.sources


def parsed(c: Column, type: str, fmt: str | None = None) -> Column:
    """`c` as `type`; text that does not fit gives NULL instead of an error."""
    if fmt is not None and type == "timestamp":
        return F.try_to_timestamp(c.cast("string"), F.lit(fmt))
    if fmt is not None and type == "date":
        return F.try_to_date(c.cast("string"), fmt)
    return c.try_cast(type)


def find_source(df: DataFrame, field: Field) -> str | None:
    """The first accepted spelling present, without regard to case."""
    present = {c.lower(): c for c in df.columns}
    return next((present[s.lower()] for s in field.spellings if s.lower() in present), None)


def map_columns(df: DataFrame, fields: Sequence[Field], missing: str = "error", also: Sequence[Column] = ()) -> DataFrame:
    """Keep, rename and type the listed columns. An absent source is an error, or NULL with `missing="null"`. Columns
    `also` are computed from the sources and put behind."""
    out = []
    for f in fields:
        source = find_source(df, f)
        if source is None and missing == "error":
            raise ValueError(f"no column for {f.target}: tried {f.spellings}")
        c = F.lit(None).cast(f.type) if source is None else parsed(quoted(source), f.type, f.fmt)
        out.append(c.alias(f.target))
    return df.select(*out, *also)


def unfit(df: DataFrame, field: Field) -> Column:
    """Does the field's cell hold text that does not fit its type?"""
    c = quoted(find_source(df, field))
    return (F.trim(c.cast("string")) != "") & parsed(c, field.type, field.fmt).isNull()


def count_unparsed(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """One row: per typed field, how many cells hold text that does not fit its type."""
    typed = [f for f in fields if f.type != "string" and find_source(df, f) is not None]
    return df.agg(*[F.count_if(unfit(df, f)).alias(f.target) for f in typed])


def schema_for(paths: Sequence[tuple[str, str]]) -> StructType:
    """A read schema holding just the listed nested fields, all as text (`array`: an array of text), to be typed by
    `flatten_paths` or `project_paths`. It spares readers of nested formats a pass to infer one."""

    def build(node: dict) -> StructType:
        return StructType([StructField(k, v if isinstance(v, DataType) else build(v)) for k, v in node.items()])

    return build(_tree(paths, lambda path, type: ArrayType(StringType()) if type == "array" else StringType()))


def _tree(paths: Sequence[tuple[str, str]], leaf) -> dict:
    tree: dict = {}
    for path, type in paths:
        *parents, last = path.split(".")
        node = tree
        for p in parents:
            node = node.setdefault(p, {})
        node[last] = leaf(path, type)
    return tree


def flatten_paths(df: DataFrame, paths: Sequence[tuple[str, str]], sep: str = "_") -> DataFrame:
    """Nested fields as top-level columns `a_b_c`, typed."""
    return df.select([_typed(p, t).alias(p.replace(".", sep)) for p, t in paths])


def project_paths(df: DataFrame, paths: Sequence[tuple[str, str]]) -> DataFrame:
    """Only the listed nested fields, typed, in their old nesting."""
    return df.select([_rebuild(name, node) for name, node in _tree(paths, _typed).items()])


def _typed(path: str, type: str) -> Column:
    c = F.col(".".join(f"`{p}`" for p in path.split(".")))
    return c if type == "array" else c.try_cast(type)


def _rebuild(name: str, node: dict | Column) -> Column:
    if isinstance(node, Column):
        return node.alias(name)
    return F.struct(*[_rebuild(k, v) for k, v in node.items()]).alias(name)


def add_missing(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Absent columns as typed NULLs, so that all years share one schema."""
    present = {c.lower() for c in df.columns}
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c.lower() not in present})


def add_constants(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.withColumns({c: F.lit(v) for c, v in values.items()})


def sql_over(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """SQL over frames named in the text as `{name}`; no shared view names."""
    return spark.sql(query, **frames)


class SchemaMismatch(ValueError):
    def __init__(self, missing: list[str], extra: list[str]):
        super().__init__(f"columns missing: {missing}, not expected: {extra}")
        self.missing, self.extra = missing, extra


def check_columns(df: DataFrame, expected: Sequence[str], ignore_case: bool = False) -> DataFrame:
    """`df` itself when its column names are exactly those expected, in any order; otherwise SchemaMismatch."""
    fold = str.lower if ignore_case else str
    have, want = sorted(map(fold, df.columns)), sorted(map(fold, expected))
    if have != want:
        raise SchemaMismatch(sorted(set(want) - set(have)), sorted(set(have) - set(want)))
    return df

"""Delimited text from lines: records whose quoted cells span lines, headings per file, cells by name.

A quote opens a cell only at the cell's start; elsewhere it is text. So whether a line ends inside a quoted cell depends on
whether it began inside one, and each line is a map of two states to two: it may keep the state, set it, or exchange it.
`operators.records` composes these maps and puts records together where their lines are read; only lines with a quote are
looked at by patterns, and only the rims of splits are moved. Files of all sizes are read the same way, in splits. Line ends
inside quoted cells stay as they are. A file's heading is its first record that is not blank.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.operators.lines import PLACE, numbered
from lakeops.operators.mapping import Field
from lakeops.operators.records import records, split_states
from lakeops.session import materialize

#: Records of delimited text are never cut, however long.
WHOLE = 2_000_000_000
IN_QUOTES = '[^"]*+(?:""[^"]*+)*+'


def not_sep(sep: str) -> str:
    return f"[^\\Q{sep}\\E]*+"


def ends_inside(text: Column, sep: str) -> tuple[Column, Column]:
    """Does a line end inside a quoted cell, if it began outside; and if it began inside one?"""
    s, rest = f"\\Q{sep}\\E", not_sep(sep)
    whole = f'{s}(?:"{IN_QUOTES}"{rest}|(?!"|{s}){rest}|(?={s}|\\z))'
    left_open = lambda cells: F.regexp_replace(cells, whole, "") != ""
    closed = F.regexp_replace(text, f'^{IN_QUOTES}"{rest}', "")
    return left_open(F.concat(F.lit(sep), text)), ~text.rlike(f'^{IN_QUOTES}"') | left_open(closed)


def quoted_records(lines: DataFrame, sep: str = ",", value: str = "value") -> DataFrame:
    """Records of delimited text: file_path, file_name, record, is_first. The text is scanned three times: for the states
    at the edges of splits, for the records there, and for all others. A quote that is never closed makes the rest of
    its file one record, as it does for any reader of such text."""
    text = F.coalesce(F.col(value), F.lit(""))
    has_quote = F.contains(text, F.lit('"'))
    outside, inside = (F.when(has_quote, open_).otherwise(plain) for open_, plain in zip(ends_inside(text, sep), (False, True), strict=True))
    told = lines.select(*PLACE, "file_name", text.alias("text"), outside.alias("open_out"), inside.alias("open_in"), (F.trim(F.rtrim(text, F.lit("\r"))) == "").alias("blank"))
    splits = materialize(split_states(told), "splits")
    found = records(told, splits.where("enters"), "\n", WHOLE)
    heads = splits.where("first IS NOT NULL").groupBy("file_path").agg(F.min(F.struct("block", F.col("first").alias("n"))).alias("_head"))
    first = F.struct("block", "n") == F.col("_head")
    record = F.regexp_replace("text", "\r\\z", "").alias("record")
    return found.join(materialize(heads, "first-lines"), "file_path").select("file_path", "file_name", record, first.alias("is_first"))


def cells_of(record: Column, sep: str = ",") -> Column:
    """The cells of a record. A quoted cell loses its quotes and has doubled ones halved; an empty cell without quotes is NULL."""
    plain = F.transform(F.split(record, f"\\Q{sep}\\E", -1), lambda c: F.nullif(c, F.lit("")))
    s, rest = f"\\Q{sep}\\E", not_sep(sep)
    found = F.regexp_extract_all(F.concat(F.lit(sep), record), F.lit(f'{s}((?:"{IN_QUOTES}(?:"|\\z))?{rest})'), F.lit(1))

    def value(cell: Column) -> Column:
        body = F.replace(F.regexp_extract(cell, f'^"({IN_QUOTES})', 1), F.lit('""'), F.lit('"'))
        tail = F.regexp_replace(cell, f'^"{IN_QUOTES}"?', "")
        return F.when(cell.startswith('"'), F.concat(body, tail)).when(cell != "", cell)

    return F.when(F.contains(record, F.lit('"')), F.transform(found, value)).otherwise(plain)


def line_records(lines: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Every line as a record, for text whose cells hold no line breaks; and the first of each file that is not blank
    (file_path, file_name, record), looked for beforehand."""
    rows = numbered(lines.select(*PLACE, "file_name", F.regexp_replace(F.coalesce(F.col(value), F.lit("")), "\r\\z", "").alias("record")))
    place = F.struct("block", "_n")
    heads = rows.where(F.trim("record") != "").groupBy("file_path", "file_name").agg(F.min(place).alias("_head"), F.min_by("record", place).alias("record"))
    heads = materialize(heads, "first-lines")
    rows = rows.join(heads.select("file_path", "_head"), "file_path").select("file_path", "file_name", "record", (place == F.col("_head")).alias("is_first"))
    return rows, heads.drop("_head")


@dataclass(frozen=True)
class Named:
    """`rows` with one text column per field and file_name; `heads` tells of each file with a heading how many fields it names."""

    rows: DataFrame
    heads: DataFrame


def by_heading(
    records: DataFrame,
    fields: Sequence[Field],
    heads: DataFrame | None = None,
    sep: str = ",",
    rule: Callable[[Column, Column], Column] | None = None,
) -> Named:
    """Rows with one text column per field, named by its first spelling, and file_name.

    Each file names its columns in its own first record; cells are picked by the first accepted spelling found there, so
    files of one family may differ in their headings. `rule` maps (heading, position) to the name compared. One row per
    file is joined to the rows; no file is opened by the driver, and a heading may have any length. Files whose heading
    names none of the fields have no rows.
    """
    written = records.where((F.trim("record") != "") & ~F.col("is_first"))
    named = lambda h, i: F.lower(F.coalesce((rule or (lambda x, _: x))(F.coalesce(h, F.lit("")), i), F.lit("")))

    def place(field: Field) -> Column:
        return F.coalesce(*[F.nullif(F.array_position("_names", s.lower()), F.lit(0)) for s in field.spellings])

    found = records.where("is_first").select("file_path", "file_name", "record") if heads is None else heads
    found = found.select("file_path", "file_name", F.transform(cells_of(F.col("record"), sep), named).alias("_names"))
    found = found.select("file_path", "file_name", F.array(*[place(f).cast("int") for f in fields]).alias("_places"))
    heads = materialize(found.withColumn("n_named", F.size(F.array_compact("_places"))), "headings")
    rows = written.join(heads.where("n_named > 0").select("file_path", "_places"), "file_path")
    rows = rows.select("file_name", "_places", cells_of(F.col("record"), sep).alias("_cells"))
    picked = [F.get("_cells", F.get("_places", F.lit(k)) - 1).alias(f.spellings[0]) for k, f in enumerate(fields)]
    return Named(rows.select(*picked, "file_name"), heads.select("file_path", "file_name", "n_named"))

"""Lists kept as JSON text in one string column: `{"<key>":["a","b"]}`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.text import strip_quotes

# Fixed value: the text a missing cell turns into on its way through a spreadsheet reader.
MISSING = "nan"


def list_text(c: Column, key: str, single: bool = False) -> Column:
    """JSON text for a cell that holds one or several, perhaps quoted, comma separated values.

    With `single` the cell is one value whatever it contains. Values stay strings, so leading zeros survive. A missing
    or blank cell gives NULL.
    """
    clean = F.trim(strip_quotes(c))
    items = F.array(clean) if single else F.transform(F.split(clean, ","), lambda x: F.trim(x))
    items = F.filter(items, lambda x: x != "")
    text = F.to_json(F.struct(items.alias(key)))
    return F.when((clean != "") & (F.lower(clean) != MISSING) & (F.size(items) > 0), text)


def list_of(c: Column, key: str) -> Column:
    """The values as an array; NULL when the text is NULL or not valid JSON."""
    return F.from_json(c, f"struct<`{key}`: array<string>>").getField(key)


def list_length(c: Column, key: str) -> Column:
    return F.json_array_length(F.get_json_object(c, f"$.{key}"))


def list_long(df: DataFrame, column: str, key: str, name: str = "phone_number") -> DataFrame:
    """One row per value, with its position."""
    keep = [c for c in df.columns if c != column]
    return df.select(*keep, F.posexplode(list_of(F.col(column), key)).alias("position", name))


def longest_list(df: DataFrame, column: str, key: str) -> int:
    """The greatest number of values in one cell: one small aggregate, read on the driver to name the columns."""
    row = df.agg(F.max(list_length(F.col(column), key))).first()
    return row[0] or 0


def list_wide(df: DataFrame, column: str, key: str, width: int | None = None, name: str = "phone_number") -> DataFrame:
    """One column per value: `<name>_0`, `<name>_1` ..., NULL past the end of the list."""
    if width is None:
        width = longest_list(df, column, key)
    keep = [c for c in df.columns if c != column]
    values = df.select(*keep, list_of(F.col(column), key).alias("_values"))
    return values.select(*keep, *[F.get("_values", F.lit(i)).alias(f"{name}_{i}") for i in range(width)])

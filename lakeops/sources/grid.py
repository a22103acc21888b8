"""Sheet grids: a JSON array of rows, each an array of cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grid_rows(df: DataFrame, body: str, header_row: int = 0, field: str | None = "values") -> DataFrame:
    """One row per record below the heading: the other columns, `position`, `headers`, `cells`.

    `body` is JSON text, either the bare grid or (with `field`) an object holding it. Cells are padded with NULL to the
    width of the heading; cells beyond it are dropped.
    """
    grid_type = "array<array<string>>"
    grid = F.from_json(body, grid_type) if field is None else F.from_json(body, f"struct<`{field}`: {grid_type}>")[field]
    keep = [c for c in df.columns if c != body]
    # a sheet without rows below the heading has an empty slice; a filter on it would parse the sheet once more
    rows = df.select(*keep, grid.alias("_grid")).select(
        *keep,
        F.get("_grid", F.lit(header_row)).alias("headers"),
        F.posexplode(F.slice("_grid", header_row + 2, F.size("_grid"))).alias("position", "_row"),
    )
    cells = F.transform("headers", lambda _, i: F.get("_row", i))
    return rows.select(*keep, "position", "headers", cells.alias("cells"))


def record_json(headers: Column, cells: Column) -> Column:
    """A JSON object heading -> cell, NULL cells included. Of two equal headings the later one counts."""
    later = lambda h, i: F.array_position(F.slice(headers, i + 2, F.size(headers)), h) > 0
    entries = F.transform(headers, lambda h, i: F.struct(h.alias("k"), F.get(cells, i).alias("v"), later(h, i).alias("x")))
    kept = F.transform(F.filter(entries, lambda e: ~e.x), lambda e: F.struct(e.k, e.v))
    return F.to_json(F.map_from_entries(kept), {"ignoreNullFields": "false"})


def grid_to_json(df: DataFrame, body: str, header_row: int = 0, field: str | None = "values") -> DataFrame:
    """One JSON object per record, for a JSON-lines file."""
    rows = grid_rows(df, body, header_row, field)
    return rows.withColumn("record", record_json(F.col("headers"), F.col("cells"))).drop("headers", "cells")


def grid_to_columns(
    df: DataFrame, body: str, columns: Sequence[str], header_row: int = 0, field: str | None = "values"
) -> DataFrame:
    """One column per wanted heading; a heading the sheet lacks gives NULL."""
    rows = grid_rows(df, body, header_row, field)
    keep = [c for c in rows.columns if c not in ("headers", "cells")]

    def cell(name: str) -> Column:
        at = F.array_position(F.reverse("headers"), name)
        return F.when(at > 0, F.get("cells", (F.size("headers") - at).cast("int")))

    return rows.select(*keep, *[cell(c).alias(c) for c in columns])

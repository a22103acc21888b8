"""Delete-then-insert of daily slices."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.operators.rows import delete_matching, join_on
from lakeops.session import materialize


def watermark(base: DataFrame, day: str) -> DataFrame:
    """One row: the greatest day in the base, NULL when it is empty."""
    return base.agg(F.max(day).alias("max_day"))


def collapse(df: DataFrame, latest: Sequence[str]) -> DataFrame:
    """One row per combination of all columns but `latest`, which take their greatest value."""
    rest = [c for c in df.columns if c not in latest]
    return df.groupBy(*rest).agg(*[F.max(c).alias(c) for c in latest]).select(df.columns)


def delete_insert_range(
    base: DataFrame,
    slices: DataFrame,
    day: str,
    keys: Sequence[str],
    latest: Sequence[str] = (),
    last: object | None = None,
    start: object | None = None,
) -> DataFrame:
    """The base after each day's slice, in order, has removed the rows with its keys and put in its own.

    Days run from after the base's greatest day (from `start`, when given) to `last`. The outcome needs no loop: of a
    key's slice rows those of its last day stay, and base rows stay whose key is in no slice. A key with a NULL part
    never matches, so its rows stay for all days.
    """
    columns, keys = base.columns, list(keys)
    rows = slices.select(columns)
    if last is not None:
        rows = rows.where(F.col(day) <= F.lit(last))
    if start is not None:
        rows = rows.where(F.col(day) >= F.lit(start))
    else:
        # an empty base lets no day in, as there is no day to continue from
        rows = rows.where(F.col(day) > watermark(base, day).scalar())

    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | F.col(k).isNull()
    # one row per key, combined before the shuffle; written, as both joins need it and its size
    last_day = materialize(rows.where(~has_null).groupBy(*keys).agg(F.max(day).alias(day)), "last_day")
    kept = collapse(join_on(rows, last_day, [*keys, day], "left_semi"), latest)
    always = collapse(rows.where(has_null), latest)
    return delete_matching(base, last_day, keys).unionByName(kept).unionByName(always)

"""Versioned history: one row per id and span of days, the open one marked current.

Columns besides the id and its attributes: from_date, to_date (9999-12-31 = open), is_current (0/1), rowhash.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeops.functions.dates import OPEN_END
from lakeops.operators.rows import delete_where, join_on
from lakeops.session import materialize

SPAN = ["from_date", "to_date", "is_current", "rowhash"]


def classify_changes(current: DataFrame, incoming: DataFrame, id_column: str, rowhash: str = "rowhash") -> DataFrame:
    """Per id: I (only incoming), D (only current), U (hashes differ) or N, with the incoming row's columns.

    Both sides are laid one under the other and aggregated to one row per id, combined before the shuffle, so no id,
    however often it comes on either side, and no number of NULL ids gathers in a task. A doubled id counts once: on the
    current side by its greatest hash, on the incoming side by its greatest hash, then row. A NULL id is no
    identity: it equals no other, so current rows without id give nothing and incoming ones come out as I, each as it is.
    """
    rest = [c for c in incoming.columns if c != id_column]
    row = F.struct(F.col(rowhash).alias("_hash"), F.struct(*rest).alias("_row"))
    known = lambda df: df.where(F.col(id_column).isNotNull())
    old = known(current).select(id_column, F.col(rowhash).alias("_old_hash"), F.lit(True).alias("_old"), F.lit(None).alias("_new"))
    new = known(incoming).select(id_column, F.lit(None).cast(current.schema[rowhash].dataType).alias("_old_hash"), F.lit(None).cast("boolean").alias("_old"), row.alias("_new"))
    old = old.withColumn("_new", F.lit(None).cast(new.schema["_new"].dataType))
    best = old.unionByName(new).groupBy(id_column).agg(F.max("_old_hash").alias("_old_hash"), F.max("_old").alias("_old"), F.max("_new").alias("_new"))
    op = (
        F.when(F.col("_old").isNull(), "I")
        .when(F.col("_new").isNull(), "D")
        .when(F.col("_old_hash") != F.col("_new._hash"), "U")
        .otherwise("N")
    )
    told = best.select(id_column, *[F.col("_new._row")[c].alias(c) for c in rest], op.alias("iud_op"))
    return told.unionByName(incoming.where(F.col(id_column).isNull()).select(id_column, *rest, F.lit("I").alias("iud_op")))


def retract(
    base: DataFrame,
    from_day: date,
    reopen: tuple[date, date] | None = None,
    clear_range: bool = False,
) -> DataFrame:
    """Drop the versions that start on `from_day` and reopen those closed on one of the days of `reopen`.

    With `clear_range` versions that start on a day of `reopen` go as well, so that a replay does not double them.
    """
    gone = F.col("from_date") == F.lit(from_day)
    if reopen is None:
        return delete_where(base, gone)
    days = lambda c: F.col(c).between(F.lit(reopen[0]), F.lit(reopen[1]))
    if clear_range:
        gone = F.coalesce(gone, F.lit(False)) | F.coalesce(days("from_date"), F.lit(False))
    again = F.coalesce(days("to_date") & (F.col("is_current") == 0), F.lit(False))
    return delete_where(base, gone).withColumns(
        {
            "to_date": F.when(again, F.lit(OPEN_END)).otherwise(F.col("to_date")),
            "is_current": F.when(again, F.lit(1)).otherwise(F.col("is_current")),
        }
    )


def one_per_day(snapshots: DataFrame, id_column: str, day: str, prefer: Sequence[str] = ()) -> DataFrame:
    """One row per (id, day): the greatest by `prefer`, then by all columns. Combined before the shuffle."""
    columns = snapshots.columns
    rest = [c for c in columns if c not in (id_column, day)]
    rank = [F.col(c).alias(f"p{i}") for i, c in enumerate(prefer)]
    best = snapshots.groupBy(id_column, day).agg(F.max(F.struct(*rank, F.struct(*rest).alias("row"))).alias("_best"))
    return best.select(id_column, day, "_best.row.*").select(columns)


def replay(
    base: DataFrame,
    snapshots: DataFrame,
    id_column: str,
    first: date,
    last: date,
    rowhash: Column,
    day: str = "data_date",
    change_only: bool = False,
    insert_new: bool = False,
    prefer: Sequence[str] = (),
) -> DataFrame:
    """The history after each day's snapshot, first..last, has closed the current version of its ids and opened a new
    one.

    No loop over days: an id's versions are its snapshots, each ending the day before the next, and its old current
    version ends the day before the first. Windows run over the snapshots of one id, one per day at most; the base is
    only joined with one row per id. Those rows are written to the scratch folder when this is called, so that the joins
    know their size; the result itself is lazy.

    Ids without a current version are left out unless `insert_new`. `change_only` skips a snapshot whose hash equals
    the one before it.
    """
    columns = base.columns
    rows = snapshots.where(F.col(day).between(F.lit(first), F.lit(last)) & F.col(id_column).isNotNull())
    starts = materialize(_starts(rows, id_column, day), "starts")
    current = join_on(base.where(F.col("is_current") == 1), starts, [id_column], "left_semi")
    if not insert_new:
        known = materialize(current.select(id_column).distinct(), "known")
        rows = join_on(rows, known, [id_column], "left_semi")
    days = one_per_day(rows, id_column, day, prefer).withColumn("rowhash", rowhash)
    if change_only:
        days = _changes(days, current, id_column, day)
        starts = materialize(_starts(days, id_column, day), "starts")
    following = F.lead(day).over(W.partitionBy(id_column).orderBy(day))
    versions = days.withColumn("_next", following).withColumns(
        {
            "from_date": F.col(day),
            "to_date": F.coalesce(F.date_sub("_next", 1), F.lit(OPEN_END)),
            "is_current": F.col("_next").isNull().cast("int"),
        }
    )
    closed = join_on(base, starts, [id_column], "left")
    ends = (F.col("is_current") == 1) & F.col("_start").isNotNull()
    closed = closed.withColumns(
        {
            "to_date": F.when(ends, F.date_sub("_start", 1)).otherwise(F.col("to_date")),
            "is_current": F.when(ends, F.lit(0)).otherwise(F.col("is_current")),
        }
    )
    return closed.select(columns).unionByName(versions.select(columns))


def _starts(days: DataFrame, id_column: str, day: str) -> DataFrame:
    return days.groupBy(id_column).agg(F.min(day).alias("_start"))


def _changes(days: DataFrame, current: DataFrame, id_column: str, day: str) -> DataFrame:
    """Snapshots whose hash differs from the one before, the current version counting as before the first."""
    old = current.groupBy(id_column).agg(F.max("rowhash").alias("rowhash")).withColumn("_old", F.lit(True))
    rows = days.withColumn("_old", F.lit(False)).unionByName(old, allowMissingColumns=True)
    order = W.partitionBy(id_column).orderBy(F.col("_old").desc(), day)
    before = F.lag("rowhash").over(order)
    marked = rows.withColumn("_before", before)
    return marked.where(~F.col("_old") & ~F.col("rowhash").eqNullSafe(F.col("_before"))).drop("_old", "_before")


def restore_day(
    base: DataFrame, snapshots: DataFrame, id_column: str, wrong_day: date, right_day: date, rowhash: Column, day: str = "data_date"
) -> DataFrame:
    """Undo the load of `wrong_day` and load `right_day` instead, new ids included."""
    undone = retract(base, wrong_day, reopen=(right_day, right_day))
    return replay(undone, snapshots, id_column, right_day, right_day, rowhash, day, insert_new=True)

"""Neighbours in raw text files.

Rows carry `file_path` and `block`, the start of the split they were read from. Splits of a file are in order, and
within a split `monotonically_increasing_id` numbers the rows kept so far without gaps. Two things follow that keep
these operators free of a sort over whole files: rows that cannot be part of a broken record need no shuffle at all, and
windows run over one split, with the join between splits done on one row per split.

`numbered` must be applied to rows that came from `read_lines` through filters and projections only: then a task run
again on another executor gives the same numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeops.functions.text import quoted
from lakeops.session import materialize

PLACE = ["file_path", "block"]
STRETCH = 100_000  # rows; well under 128 of them make a split of text, from where Spark's aggregate of lists sorts


def numbered(df: DataFrame) -> DataFrame:
    """Add `_n`, counting up by one within a split."""
    return df.withColumn("_n", F.monotonically_increasing_id())


def gathered(df: DataFrame, wanted: Column) -> tuple[DataFrame, DataFrame]:
    """The `wanted` rows of a numbered frame, and one row per split with rows: `_first` and `_last` row number, both also of
    the split before.

    The text is read once, when this is called: stretches of `STRETCH` rows are aggregated where they are read, each to its
    least and greatest number and a list of its wanted rows, and written to the scratch folder. A list is bounded by the
    stretch, and a split has too few stretches for the aggregate to sort.
    """
    rest = [c for c in df.columns if c not in PLACE]
    row = F.when(wanted, F.struct(*[quoted(c) for c in rest]))
    stretch = F.floor(F.col("_n") / STRETCH).alias("_stretch")
    told = df.groupBy(*PLACE, stretch).agg(F.min("_n").alias("_first"), F.max("_n").alias("_last"), F.collect_list(row).alias("_rows"))
    parts = materialize(told.drop("_stretch"), "open-rows")
    rows = parts.select(*PLACE, F.explode("_rows").alias("_row"))
    by_file = W.partitionBy("file_path").orderBy("block")  # one row per split of a file
    edges = parts.groupBy(*PLACE).agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"))
    edges = edges.withColumns({"_before": F.lag("block").over(by_file), "_before_last": F.lag("_last").over(by_file)})
    return rows.select(*PLACE, *[F.col("_row").getField(c).alias(c) for c in rest]), edges


def with_next(wanted: DataFrame, edges: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and edges of `gathered`: each row with `_next`, the given columns of the row right after it in the
    file if that is one of them too, else NULL. Also `_first` and `_last` of the split.

    Windows run over stretches of `STRETCH` row numbers, so that no task sorts more than a share of a split. The first
    row of a stretch is also placed behind the last row of the one before, in its split or in the split before.
    """
    row = F.struct("_n", *columns)
    rows = wanted.join(edges, PLACE)
    leads = (F.col("_n") == F.col("_first")) & F.col("_before").isNotNull()
    stretch = lambda n: F.floor(n / STRETCH).alias("stretch")
    home = F.struct("block", stretch(F.col("_n")), "_n", F.lit(False).alias("copy"))
    last = F.when(leads, F.col("_before_last")).otherwise(F.col("_n") - 1)  # the row before, if there is one
    away = F.struct(F.when(leads, F.col("_before")).otherwise(F.col("block")).alias("block"), stretch(last), (last + 1).alias("_n"), F.lit(True).alias("copy"))
    opens = leads | ((F.col("_n") > F.col("_first")) & (stretch(F.col("_n")) != stretch(last)))
    seats = F.when(opens, F.array(home, away)).otherwise(F.array(home))
    kept = [c for c in rows.columns if c not in ("_before", "_before_last")]
    seated = rows.withColumn("_row", row).select(*kept, "_row", F.explode(seats).alias("_seat"))
    window = W.partitionBy("file_path", "_seat.block", "_seat.stretch").orderBy("_seat._n")
    after = F.lead(F.struct("_seat._n", "_row")).over(window)
    seen = seated.withColumn("_after", after).where(~F.col("_seat.copy"))
    follows = F.col("_after._n") == F.col("_n") + 1
    return seen.withColumn("_next", F.when(follows, F.col("_after._row"))).drop("_row", "_seat", "_after")

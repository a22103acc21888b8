"""Rows broken in raw delimited text: stray headings, delimiters and line breaks inside values."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeops.functions.text import ends_with_stamp, has_stamp, is_stamp, quoted
from lakeops.operators.lines import PLACE, gathered, numbered, with_next
from lakeops.operators.records import LIMIT, records


@dataclass(frozen=True)
class LogColumns:
    """Names of the four cells of a log line, as in its heading, and of the cell behind them."""

    id: str = "Customer Id"
    phone: str = "Phone number"
    name: str = "Customer Name"
    stamp: str = "Login Time"
    spill: str = "spill"

    @property
    def cells(self) -> list[str]:
        return [self.id, self.phone, self.name, self.stamp]


LOG = LogColumns()


def split_cells(lines: DataFrame, cols: LogColumns = LOG, value: str = "value", sep: str = ",") -> DataFrame:
    """`value` cut into four cells and a spill cell. Short lines are padded with NULL, a blank line is all NULL, what
    lies beyond the fifth cell is dropped."""
    text = F.trim(quoted(value))
    cells = F.when(text != "", F.split(text, f"\\Q{sep}\\E", -1))
    rest = [c for c in lines.columns if c != value]
    names = [*cols.cells, cols.spill]
    return lines.select(*rest, cells.alias("_cells")).select(
        *rest, *[F.get("_cells", F.lit(i)).alias(n) for i, n in enumerate(names)]
    )


def drop_headers(df: DataFrame, cols: LogColumns = LOG) -> DataFrame:
    """Without heading lines, wherever they stand, also those cut short: every cell present says its own name."""
    heading = quoted(cols.id).isNotNull()
    for c in cols.cells:
        heading = heading & F.coalesce(quoted(c) == c, F.lit(True))
    return df.where(~heading)


def data_lines(lines: DataFrame, cols: LogColumns = LOG, value: str = "value") -> DataFrame:
    """Raw lines without blank ones and headings: as `drop_headers` and `drop_empty` on the cells, before cutting."""
    text = F.trim(quoted(value))
    names = [f"\\Q{c}\\E" for c in cols.cells]
    heading = "".join(f"(,{n}" for n in names[1:]) + "(,.*)?" + ")?" * (len(names) - 1)
    is_heading = text.startswith(cols.id) & text.rlike(f"(?s)^{names[0]}{heading}$")
    return lines.where((text != "") & ~is_heading)


def drop_empty(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Without rows that are NULL in all `columns`."""
    return df.dropna(how="all", subset=[f"`{c}`" for c in columns])


def repair_delimiter(df: DataFrame, cols: LogColumns = LOG) -> DataFrame:
    """A delimiter inside the name pushed its rest into the stamp cell and the stamp into the spill cell: put both
    back, with a space where the delimiter was."""
    name, stamp, spill = quoted(cols.name), quoted(cols.stamp), quoted(cols.spill)
    pushed = stamp.isNotNull() & ~is_stamp(stamp)
    return df.withColumns(
        {
            cols.name: F.when(pushed, F.concat(name, F.lit(" "), stamp)).otherwise(name),
            cols.stamp: F.when(spill != "", spill).otherwise(stamp),
        }
    ).drop(cols.spill)


def drop_continuations(df: DataFrame, cols: LogColumns = LOG) -> DataFrame:
    """Without rows that have neither name nor stamp: the tail of a broken line."""
    return df.where(~(quoted(cols.name).isNull() & quoted(cols.stamp).isNull()))


def repair_linebreak(
    df: DataFrame, cols: LogColumns = LOG, name_min: int | None = 18, stamp_min: int | None = 10
) -> DataFrame:
    """A line break inside the name left a row without stamp, followed by a row with only two cells, the rest of the
    name and the stamp: join them and drop the second.

    The stamp is taken when it has more than `stamp_min` characters, the rest of the name when the stamp has more than
    `name_min`; None takes whatever the next row has. Rows with a stamp are never part of this and are passed on where
    they are. `df` needs file_path and block, and must come straight from the reader. The text is read twice: rows without a
    stamp and the edges of splits go to the scratch folder when this is called, all others are read as the result is.
    """
    stamp = quoted(cols.stamp)
    open_rows = with_next(*gathered(numbered(df), stamp.isNull()), cols.cells)
    after = lambda c: F.col("_next").getField(c)
    tail = after(cols.id).isNotNull() & after(cols.name).isNull() & after(cols.stamp).isNull()

    def long_enough(least: int | None) -> Column:
        return F.lit(True) if least is None else F.length(after(cols.phone)) > least

    name = quoted(cols.name)
    fixed = open_rows.withColumns(
        {
            cols.name: F.when(tail & long_enough(name_min), F.concat(name, F.lit(" "), after(cols.id))).otherwise(name),
            cols.stamp: F.when(tail & long_enough(stamp_min), after(cols.phone)).otherwise(stamp),
        }
    )
    columns = [quoted(c) for c in df.columns]
    whole = df.where(stamp.isNotNull()).select(columns)
    return drop_continuations(whole.unionByName(fixed.select(columns)), cols)


def clean_log(lines: DataFrame, cols: LogColumns = LOG) -> DataFrame:
    """All repairs of a login log, from raw lines to four cells."""
    return repair_linebreak(repair_delimiter(split_cells(data_lines(lines, cols), cols), cols), cols)


def detect_pairs(df: DataFrame, cols: LogColumns = LOG) -> DataFrame:
    """Broken lines with the line that completes them: the four cells, and the next line's as `next_<cell>`.

    A row without stamp is the first half when the next row's first cell has no digit and its second holds a stamp. Of
    several such rows in a run every other one counts, from the first, as a row used as second half starts no pair.
    The text is read once, when this is called: rows that may be halves and the edges of splits go to the scratch folder.
    """
    id_cell, phone, stamp = quoted(cols.id), quoted(cols.phone), quoted(cols.stamp)
    tail = F.coalesce(~id_cell.rlike(r"\d") & has_stamp(phone), F.lit(False))
    wanted, edges = gathered(numbered(df).withColumn("_tail", tail), stamp.isNull() | F.col("_tail"))
    seen = with_next(wanted, edges, [*cols.cells, "_tail"])
    heads = seen.where(stamp.isNull() & F.col("_next._tail"))

    # runs within a split, then how long a run already is when it crosses into a split
    at = W.partitionBy(*PLACE)
    runs = heads.withColumn("_run", F.col("_n") - F.row_number().over(at.orderBy("_n")))
    runs = runs.withColumn("_k", F.row_number().over(W.partitionBy(*PLACE, "_run").orderBy("_n")))
    runs = runs.withColumn("_leads", F.min("_n").over(W.partitionBy(*PLACE, "_run")) == F.col("_first"))
    per_split = runs.groupBy(*PLACE).agg(
        F.max(F.when(F.col("_n") == F.col("_last"), F.col("_k"))).alias("_open"),
        F.max(F.when((F.col("_n") == F.col("_last")) & F.col("_leads"), F.lit(1))).alias("_whole"),
    )
    splits = edges.join(per_split, PLACE, "left")
    by_file = W.partitionBy("file_path").orderBy("block")
    chain = F.sum(F.when(F.col("_whole").isNull(), 1).otherwise(0)).over(by_file)
    splits = splits.withColumn("_chain", chain)
    length = F.sum(F.coalesce("_open", F.lit(0))).over(W.partitionBy("file_path", "_chain").orderBy("block"))
    splits = splits.withColumn("_length", length).withColumn("_carry", F.lag("_length", 1, 0).over(by_file))
    placed = runs.join(splits.select(*PLACE, "_carry"), PLACE)
    k = F.col("_k") + F.when(F.col("_leads"), F.col("_carry")).otherwise(0)
    chosen = placed.where(k % 2 == 1)
    nexts = [F.col("_next").getField(c).alias(f"next_{c}") for c in cols.cells]
    return chosen.select(*PLACE, *[quoted(c) for c in cols.cells], *nexts)


def pair_text(pairs: DataFrame, cols: LogColumns = LOG) -> DataFrame:
    """Each pair back as its two lines of text, NULL cells left out."""
    first = F.concat_ws(",", *[quoted(c) for c in cols.cells])
    second = F.concat_ws(",", *[quoted(f"next_{c}") for c in cols.cells])
    return pairs.select(*PLACE, first.alias("first_line"), second.alias("second_line"))


def join_fragments(lines: DataFrame, value: str = "value", limit: int = LIMIT) -> DataFrame:
    """Logical records: lines are joined, by a space, up to one that ends with a stamp. Blank lines are ignored.

    Columns: file_path, record, complete, piece. What follows a file's last stamp comes out with complete = false, and so
    do the pieces, numbered in order, of a record longer than `limit` characters. Lines are joined where they are read;
    only a split's first record and unfinished last one are joined across splits, so a file without any stamp takes no
    more memory than others.
    """
    text = F.trim(quoted(value))
    open_ = ~ends_with_stamp(text)
    told = lines.where(text != "").select(*PLACE, F.lit("").alias("file_name"), text.alias("text"), open_.alias("open_out"), open_.alias("open_in"))
    return records(told, None, " ", limit).select("file_path", F.col("text").alias("record"), "complete", "piece")

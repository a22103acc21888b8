"""Records that span lines, put together in the splits they are read in.

Each line says whether a record is still open behind it, if it was open before the line (`open_in`) or was not
(`open_out`). Within a split lines come in order, so a task carries that state along and puts records together as it reads;
nothing is shuffled but the rims, at most two stretches per split that other splits go on with. That is Arrow batches
in and out: a record by record carry in reading order is what Spark's own expressions need a sort for. Lines that neither
open nor close anything are passed on by whole stretches.

No record is collected beyond `limit` characters: what is longer comes out in pieces, in order, none of them complete.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeops.operators.lines import PLACE
from lakeops.session import materialize

LIMIT = 64_000_000
SPLITS = "file_path string, block bigint, after_out boolean, after_in boolean, first bigint"
#: A stretch of lines of a split: does a record begin with it, does one end with it; `piece` counts cuts by the limit.
PARTS = "file_path string, file_name string, block bigint, n bigint, piece int, text string, begins boolean, ends boolean"
PART_SCHEMA = pa.schema([("file_path", pa.string()), ("file_name", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("piece", pa.int32()), ("text", pa.string()), ("begins", pa.bool_()), ("ends", pa.bool_())])


def runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of one split after the other."""
    if batch.num_rows:
        path, block = batch.column("file_path"), batch.column("block")
        other = pc.or_(pc.not_equal(path[1:], path[:-1]), pc.not_equal(block[1:], block[:-1])).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(other) + 1).tolist(), batch.num_rows]
        for s, e in zip(edges[:-1], edges[1:], strict=True):
            yield batch.slice(s, e - s)


def flags(run: pa.RecordBatch, name: str) -> np.ndarray:
    return run.column(name).to_numpy(zero_copy_only=False).astype(bool)


def split_states(lines: DataFrame) -> DataFrame:
    """For lines (file_path, block, open_out, open_in, blank): (file_path, block, enters, first), a row per split. Is a
    record open where the split begins, and which of its lines, counted from 0, is the first that is not blank?

    Each split is a map of two states to two; maps are composed over the splits of a file, one row each.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, maps, n, first = None, (False, True), 0, None
        out: list[tuple] = []
        for batch in batches:
            for run in runs(batch):
                here = (run.column("file_path")[0].as_py(), run.column("block")[0].as_py())
                if here != at:
                    if at is not None:
                        out.append((*at, *maps, first))
                    at, maps, n, first = here, (False, True), 0, None
                o, i = flags(run, "open_out"), flags(run, "open_in")
                sets = np.flatnonzero(o == i)
                swaps = o & ~i
                if len(sets):  # behind the last line that sets the state only exchanges count
                    state = bool(o[sets[-1]]) ^ bool(swaps[sets[-1] + 1 :].sum() % 2)
                    maps = (state, state)
                elif swaps.sum() % 2:
                    maps = (not maps[0], not maps[1])
                written = np.flatnonzero(~flags(run, "blank"))
                if first is None and len(written):
                    first = n + int(written[0])
                n += len(o)
        if at is not None:
            out.append((*at, *maps, first))
        types = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64()]
        columns = list(zip(*out, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["file_path", "block", "after_out", "after_in", "first"])

    splits = lines.select("file_path", "block", "open_out", "open_in", "blank").mapInArrow(work, SPLITS)
    so_far = W.partitionBy("file_path").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    swaps = F.coalesce(F.sum((F.col("after_out") & ~F.col("after_in")).cast("int")).over(so_far), F.lit(0))
    splits = splits.withColumn("swaps", swaps)
    # the state behind the last split that set it, and the exchanges up to there, that split's own place included
    sets = F.when(F.col("after_out") == F.col("after_in"), F.struct("after_out", "swaps"))
    last = F.last(sets, ignorenulls=True).over(so_far)
    state = F.coalesce(last["after_out"], F.lit(False)).cast("int") + F.col("swaps") - F.coalesce(last["swaps"], F.lit(0))
    return splits.select(*PLACE, (state % 2 == 1).alias("enters"), "first")


def stretches(lines: DataFrame, sep: str, limit: int, whole: bool) -> DataFrame:
    """`PARTS` of lines (file_path, file_name, block, text, open_out, open_in, enters): records that lie within a split, or
    (not `whole`) the stretches at the rims of splits and the pieces of what is longer than `limit`."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, carried = None, Carried()
        for batch in batches:
            out: list[tuple] = []
            for run in runs(batch):
                here = (run.column("file_path")[0].as_py(), run.column("file_name")[0].as_py(), run.column("block")[0].as_py())
                if here != at:
                    if at is not None and carried.parts and not whole:
                        out.append((*at, *carried.row(sep, False)))
                    at, carried = here, Carried(bool(run.column("enters")[0].as_py()))
                texts = run.column("text")
                starts, last_open = boundaries(flags(run, "open_out"), flags(run, "open_in"), carried.open)
                sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
                upto = np.concatenate([[0], np.cumsum(sizes + len(sep))])
                # stretches [starts[k], starts[k + 1]): the first may go on from the batch before, the last into the next
                inside = np.ones(len(starts) - 1, bool)
                inside[0] &= not carried.open
                inside[-1] &= not last_open
                short = upto[starts[1:]] - upto[starts[:-1]] <= limit
                if whole and (inside & short).any():
                    lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), texts).filter(pa.array(inside & short))
                    yield whole_records(here, carried.n + starts[:-1][inside & short], pc.binary_join(lists, sep))
                for k in np.flatnonzero(~(inside & short)).tolist():
                    s, e = int(starts[k]), int(starts[k + 1])
                    if k or not carried.open:
                        carried.begin(carried.n + s)
                    for text, size in zip(texts.slice(s, e - s).to_pylist(), sizes[s:e].tolist(), strict=True):
                        if carried.size > limit:
                            if not whole:
                                out.append((*at, *carried.row(sep, False)))
                            carried.cut()
                        carried.parts.append(text)
                        carried.size += size + len(sep)
                    carried.open = last_open and k == len(inside) - 1
                    if not carried.open:
                        if whole == (carried.begins and carried.piece == 0):
                            out.append((*at, *carried.row(sep, True)))
                        carried.begin(0)
                carried.open = last_open
                carried.n += len(sizes)
            if out:
                yield parts_of(out)
        if at is not None and carried.parts and not whole:
            yield parts_of([(*at, *carried.row(sep, False))])

    return lines.select("file_path", "file_name", "block", "text", "open_out", "open_in", "enters").mapInArrow(work, PARTS)


class Carried:
    """The record that is open where a batch of a split's lines ends."""

    def __init__(self, open_: bool = False):
        self.open, self.begins, self.n = open_, not open_, 0
        self.parts: list[str] = []
        self.size = self.first = self.piece = 0

    def begin(self, first: int) -> None:
        self.parts, self.size, self.first, self.piece, self.begins = [], 0, first, 0, True

    def cut(self) -> None:
        self.parts, self.size, self.piece = [], 0, self.piece + 1

    def row(self, sep: str, ends: bool) -> tuple:
        return self.first, self.piece, sep.join(self.parts), self.begins and self.piece == 0, ends


def boundaries(open_out: np.ndarray, open_in: np.ndarray, open_: bool) -> tuple[np.ndarray, bool]:
    """Where stretches of lines begin, and the number of lines; and whether a record is open behind the last."""
    ends = np.zeros(len(open_out), bool)  # lines with no record open behind them
    changes = np.flatnonzero(open_out | ~open_in).tolist()
    if (open_out == open_in).all():
        ends = ~open_out
    else:
        done = 0
        for k in changes:
            if not open_:
                ends[done:k] = True
            open_ = bool(open_in[k] if open_ else open_out[k])
            ends[k] = not open_
            done = k + 1
        if not open_:
            ends[done:] = True
    starts = np.concatenate([[0], np.flatnonzero(ends[:-1]) + 1, [len(ends)]])
    return starts, not ends[-1]


def whole_records(at: tuple, firsts: np.ndarray, texts: pa.Array) -> pa.RecordBatch:
    size = len(firsts)
    yes = pa.repeat(pa.scalar(True), size)
    columns = [*(pa.repeat(pa.scalar(x, f.type), size) for x, f in zip(at, PART_SCHEMA, strict=False)), pa.array(firsts, pa.int64()), pa.repeat(pa.scalar(0, pa.int32()), size), texts, yes, yes]
    return pa.RecordBatch.from_arrays(columns, schema=PART_SCHEMA)


def parts_of(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PART_SCHEMA, strict=True)], schema=PART_SCHEMA)


def across_splits(rims: DataFrame, sep: str, limit: int) -> DataFrame:
    """Records of the stretches at the rims: (file_path, file_name, block, n, piece, text, ends).

    Which stretches belong together, and where a record grows beyond `limit`, follows from their lengths alone; texts are
    then gathered by record and piece, never more than `limit` and one stretch at once.
    """
    rims = materialize(rims, "rims")
    place = ["file_path", "block", "n", "piece"]
    by_file = W.partitionBy("file_path").orderBy("block", "n", "piece")
    before = by_file.rowsBetween(W.unboundedPreceding, -1)
    marks = rims.select(*place, "begins", F.col("ends").cast("int").alias("ends"), F.length("text").alias("size"))
    # a stretch begins a record if it says so, or if the one before it in the file ended one
    begins = F.col("begins") | (F.coalesce(F.lag("ends").over(by_file), F.lit(1)) == 1)
    marks = marks.withColumn("record", F.sum(begins.cast("int")).over(by_file.rowsBetween(W.unboundedPreceding, 0)))
    by_record = W.partitionBy("file_path", "record").orderBy("block", "n", "piece")
    upto = F.sum("size").over(by_record.rowsBetween(W.unboundedPreceding, -1))
    total = F.sum("size").over(W.partitionBy("file_path", "record"))
    marks = marks.withColumn("part", F.when(total <= limit, 0).otherwise(F.floor(F.coalesce(upto, F.lit(0)) / limit)))
    of_record = W.partitionBy("file_path", "record")
    numbers = F.dense_rank().over(of_record.orderBy("part")) - 1
    marks = marks.select(*place, "record", numbers.alias("part"), (F.max("part").over(of_record) == 0).alias("whole"))
    placed = rims.join(marks, place)
    listed = F.array_sort(F.collect_list(F.struct("block", "n", "piece", "text")))
    grouped = placed.groupBy("file_path", "file_name", "record", "part", "whole").agg(listed.alias("parts"), F.max("ends").alias("ends"))
    first = F.get("parts", F.lit(0))
    text = F.array_join(F.transform("parts", lambda p: p["text"]), sep)
    return grouped.select(
        "file_path", "file_name", first["block"].alias("block"), first["n"].alias("n"), F.col("part").cast("int").alias("piece"), text.alias("text"),
        (F.col("ends") & F.col("whole")).alias("ends"),
    )


def records(lines: DataFrame, enters: DataFrame | None, sep: str, limit: int = LIMIT) -> DataFrame:
    """Records of lines (file_path, file_name, block, text, open_out, open_in): file_path, file_name, block, n, piece,
    text, complete. (block, n) is the place of a record's first line.

    `enters` holds the splits (file_path, block) that begin inside a record. None is for lines that say by
    themselves whether a record is open behind them.
    """
    if enters is None:
        entered = lines.withColumn("enters", F.lit(True))
    else:
        # at most one row for each split but the first of a file, so a millionth of the text; and lines must keep their order
        inside = F.broadcast(enters.select(*PLACE, F.lit(True).alias("enters")))
        entered = lines.join(inside, PLACE, "left").withColumn("enters", F.coalesce("enters", F.lit(False)))
    inner = stretches(entered, sep, limit, whole=True).withColumnRenamed("ends", "complete").drop("begins")
    rims = stretches(entered, sep, limit, whole=False)
    return inner.unionByName(across_splits(rims, sep, limit).withColumnRenamed("ends", "complete"))

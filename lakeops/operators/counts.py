"""Distinct counts under many conditions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeops.functions.dates import Span

_BITS = 62


def conditional_distinct(
    df: DataFrame, keys: Sequence[str], id_column: str, conditions: dict[str, Column], any_row: dict[str, Column] | None = None
) -> DataFrame:
    """Per group: how many distinct ids have a row meeting each condition.

    Same result as one `count(distinct case when ... end)` per condition, but instead of multiplying the rows by the
    number of conditions, rows are first reduced to one per (group, id) with the conditions as bits of a number. That
    step combines before the shuffle and spreads a hot group over its ids; the second step sums bits.

    `any_row` adds Boolean columns: does the group have any row meeting the condition, NULL ids included.
    """
    any_row = any_row or {}
    names = [*conditions, *any_row]
    tests = [*conditions.values(), *any_row.values()]
    masks = []
    for start in range(0, len(tests), _BITS):
        bits = [F.when(t, F.lit(1 << i).cast("bigint")).otherwise(0) for i, t in enumerate(tests[start : start + _BITS])]
        word = bits[0]
        for b in bits[1:]:
            word = word.bitwiseOR(b)
        masks.append(F.bit_or(word).alias(f"_m{start // _BITS}"))
    per_id = df.groupBy(*keys, id_column).agg(*masks)

    def bit(i: int) -> Column:
        return F.shiftright(F.col(f"_m{i // _BITS}"), i % _BITS).bitwiseAND(F.lit(1).cast("bigint"))

    out = []
    for i, name in enumerate(names):
        if name in conditions:
            out.append(F.sum(F.when(F.col(id_column).isNotNull(), bit(i)).otherwise(0)).alias(name))
        else:
            out.append((F.max(bit(i)) == 1).alias(name))
    return per_id.groupBy(*keys).agg(*out)


@dataclass(frozen=True)
class Running:
    """A window that runs within periods: `start` gives a day's first day of period (None: all days are one period);
    only days in `limit` count."""

    start: Callable[[Column], Column] | None
    limit: Span


#: Starts of the usual periods; weeks begin on Sunday.
DAY = lambda d: d
WEEK = lambda d: F.date_sub(d, F.dayofweek(d) - 1)
MONTH = lambda d: F.trunc(d, "month").cast("date")
QUARTER = lambda d: F.trunc(d, "quarter").cast("date")


def distinct_by_day(
    df: DataFrame,
    key: str,
    id_column: str,
    day: Column,
    windows: dict[str, Running],
    ends: dict[date, dict[str, Span]],
    any_row: dict[str, dict[date, Span]] | None = None,
) -> DataFrame:
    """Distinct ids per key in each running window, for many end days at once: key, data_date, one column a window.

    `ends` gives for each end day the days its windows cover, each from a period's start (cut by the window's limit) to
    some day of that period. `any_row` adds Boolean columns: has the key a row on those days, NULL ids included.

    Within a period an id counts from its first day on. So the table is reduced to distinct (key, id, day), marked with
    the windows it is new in, and that to new ids per key and stretch of days that all windows treat alike. Running
    sums over these give what each window counts; rows are never copied per end day.
    """
    any_row = any_row or {}
    spans = [w.limit for w in windows.values()] + [s for days in any_row.values() for s in days.values()]
    universe = Span(min(s.first for s in spans), max(s.last for s in spans))
    rows = df.where(universe.holds(day)).select(key, id_column, F.to_date(day).alias("_day"))
    days = rows.groupBy(key, id_column, "_day").agg(F.lit(1).alias("_one"))
    before = F.lag("_day").over(W.partitionBy(key, id_column).orderBy("_day"))  # a group has one row a day at most
    real = F.col(id_column).isNotNull()

    def new(w: Running) -> Column:
        opening = F.lit(w.limit.first)
        if w.start is not None:
            opening = F.greatest(opening, w.start(F.col("_day")))
        first = F.col("_before").isNull() | (F.col("_before") < opening)
        return F.count_if(real & first & w.limit.holds(F.col("_day")))

    covers = [s for by_name in ends.values() for s in by_name.values()]
    covers += [s for by_day in any_row.values() for s in by_day.values()]
    per_stretch = (
        days.withColumn("_before", before)
        .groupBy(key, _stretch_start(F.col("_day"), universe, covers).alias("_from"))
        .agg(*[new(w).alias(f"_new_{name}") for name, w in windows.items()])
    )
    spans_of = {name: [ends[e][name] for e in sorted(ends)] for name in windows} | {name: [days[e] for e in sorted(ends)] for name, days in any_row.items()}
    return _totals_between(per_stretch, key, sorted(ends), spans_of, list(windows), list(any_row))


def _totals_between(per_stretch: DataFrame, key: str, ends: list[date], spans_of: dict[str, list[Span]], counted: list[str], present: list[str]) -> DataFrame:
    """Per key and end day, for each window the sum over the stretches that begin in its span.

    Each key's stretches get running sums, which are read off at the days before and at the end of all spans: those
    days stand among the stretches as rows of their own, so one window over a key's rows gives them all. What a window
    counts is then the difference of two entries of the key's list. Work is linear in stretches plus days.
    """
    before = lambda d: d - timedelta(days=1)
    last = lambda s: max(s.last, before(s.first))  # noqa: E731, a span may be empty
    marks = sorted({d for spans in spans_of.values() for s in spans for d in (before(s.first), last(s))})
    place = {d: i for i, d in enumerate(marks)}
    numbers = lambda values: F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")  # noqa: E731, folded into one literal
    origin = marks[0]
    asked = F.explode(F.transform(numbers([(d - origin).days for d in marks]), lambda n: F.date_add(F.lit(origin), n)))

    sums = {f"_new_{name}": F.col(f"_new_{name}") for name in counted} | {"_rows": F.lit(1)}
    rows = per_stretch.select(key, "_from", *[c.cast("long").alias(n) for n, c in sums.items()], F.lit(0).alias("_asks"))
    asks = per_stretch.select(key).distinct().select(key, asked.alias("_from"), *[F.lit(0).cast("long").alias(n) for n in sums], F.lit(1).alias("_asks"))
    so_far = W.partitionBy(key).orderBy("_from", "_asks").rowsBetween(W.unboundedPreceding, 0)
    totals = rows.unionByName(asks).select(key, "_from", "_asks", *[F.sum(n).over(so_far).alias(n) for n in sums])
    lists = totals.where("_asks = 1").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_from", *sums))).alias("_at"))

    per_end = lists.select(key, "_at", F.explode(F.sequence(F.lit(0), F.lit(len(ends) - 1))).alias("_end"))

    def between(name: str, what: str) -> Column:
        at = lambda days: F.get("_at", F.get(numbers([place[d] for d in days]), F.col("_end")))[what]
        return at([last(s) for s in spans_of[name]]) - at([before(s.first) for s in spans_of[name]])

    inside = {name: between(name, "_rows") > 0 for name in spans_of}
    some = F.lit(False)
    for c in inside.values():
        some = some | c
    end_day = F.date_add(F.lit(ends[0]), F.get(numbers([(e - ends[0]).days for e in ends]), F.col("_end")))
    return per_end.where(some).select(key, end_day.alias("data_date"), *[between(n, f"_new_{n}").alias(n) for n in counted], *[inside[n].alias(n) for n in present])


def _stretch_start(day: Column, universe: Span, covers: Sequence[Span]) -> Column:
    """The first day of the stretch `day` lies in; the spans begin and end only where stretches do."""
    edges = {s.first for s in covers} | {s.last + timedelta(days=1) for s in covers}
    starts, start = [], 0
    for i in range((universe.last - universe.first).days + 1):
        if universe.first + timedelta(days=i) in edges:
            start = i
        starts.append(start)
    table = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<int>")  # folded into one literal
    return F.date_add(F.lit(universe.first), F.get(table, F.date_diff(day, F.lit(universe.first))))

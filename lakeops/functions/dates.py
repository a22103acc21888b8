"""Dates: file days, partition keys, report windows."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# The clock all day boundaries follow, and the usual key formats.
ZONE = "Asia/Yangon"
KEY_FORMATS = {"year_key": "yyyy", "month_key": "yyyyMM", "day_key": "yyyyMMdd"}
OPEN_END = date(9999, 12, 31)


def local_day(as_of: datetime, zone: str = ZONE) -> date:
    """The calendar day of an instant in `zone`; an instant without a zone counts as UTC."""
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    return as_of.astimezone(ZoneInfo(zone)).date()


def local_day_of(utc: Column, zone: str = ZONE) -> Column:
    """Column form of `local_day` for a timestamp without zone that holds UTC."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc))


def file_day(name: Column, pattern: str, fmt: str) -> Column:
    """The day in a file name: the groups of `pattern`, joined, read as `fmt`; NULL when it is not a date.

    `pattern` has one group for a date written as one token, or three for year, month and day apart.
    """
    groups = _group_count(pattern)
    text = F.concat(*[F.regexp_extract(name, pattern, i + 1) for i in range(groups)])
    return F.try_to_date(text, fmt)


def _group_count(pattern: str) -> int:
    import re

    return re.compile(pattern).groups


def date_keys(
    day: Column, shift: int = -1, formats: dict[str, str] | None = None, as_int: bool = False
) -> dict[str, Column]:
    """Partition key columns for `withColumns`: the day moved by `shift` days, in each format."""
    moved = F.date_add(day, shift)
    keys = {name: F.date_format(moved, fmt) for name, fmt in (formats or KEY_FORMATS).items()}
    return {name: c.cast("int") for name, c in keys.items()} if as_int else keys


def within(when: Column, first: date, last: date) -> Column:
    """`when` lies on one of the days first..last.

    Written as a range on the bare column so that it reaches the Parquet reader for dates and timestamps alike.
    """
    return (when >= F.lit(first)) & (when < F.lit(last + timedelta(days=1)))


@dataclass(frozen=True)
class Span:
    """Days first..last, both included."""

    first: date
    last: date

    def holds(self, when: Column) -> Column:
        return within(when, self.first, self.last)

    def cut(self, other: Span) -> Span:
        return Span(max(self.first, other.first), min(self.last, other.last))


def week_start(day: date) -> date:
    """The Sunday on or before `day`."""
    return day - timedelta(days=day.isoweekday() % 7)


def month_span(year: int, month: int) -> Span:
    after = date(year + month // 12, month % 12 + 1, 1)
    return Span(date(year, month, 1), after - timedelta(days=1))


def to_date_windows(day: date, run_year: int | None = None) -> dict[str, Span]:
    """Day, week, month and quarter windows ending on `day`.

    The month window takes its month from `day` but its year from `run_year`, and is a whole month: what lies after
    `day` is for the caller's own range to cut off.
    """
    quarter = date(day.year, (day.month - 1) // 3 * 3 + 1, 1)
    return {
        "d_1": Span(day, day),
        "wtd": Span(week_start(day), day),
        "mtd": month_span(day.year if run_year is None else run_year, day.month),
        "qtd": Span(quarter, day),
    }


def whole_years(start: Column, end: Column) -> Column:
    """Full years between two dates."""
    return F.floor(F.months_between(end, start, roundOff=False) / 12).cast("int")

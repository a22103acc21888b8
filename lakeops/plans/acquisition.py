"""Acquisition report: distinct customers each agent registered, over calendar windows and a fiscal quarter."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.dates import Span, to_date_windows, whole_years
from lakeops.operators.counts import DAY, MONTH, QUARTER, WEEK, Running, conditional_distinct, distinct_by_day
from lakeops.operators.rows import at_latest


@dataclass(frozen=True)
class Terms:
    """Launch day, fiscal quarter and fiscal year of the report."""

    # Fixed values
    launch: date = date(2023, 10, 1)
    quarter: Span = Span(date(2025, 1, 3), date(2025, 4, 2))
    year: Span = Span(date(2025, 1, 3), date(2026, 1, 2))


# Columns of the report.
CALENDAR = ["cal_d_1", "cal_wtd", "cal_mtd", "cal_qtd", "btd", "tc_ytd"]
FISCAL = ["tc_d_1", "tc_wtd", "tc_mtd", "tc_qtd"]
STAFF = [
    "employee_id",
    "employee_full_name",
    "agentid",
    "phonenumber",
    "dateofbirth",
    "gender",
    "dateofjoining",
    "serviceyears",
    "branch_code",
    "branch_name",
    "joblocationstate",
    "joblocationtownship",
]
COLUMNS = [*STAFF, *FISCAL, "btd", "cal_d_1", "cal_wtd", "cal_mtd", "cal_qtd", "tc_ytd", "center_type"]


def report_spans(day: date, run_year: int | None, terms: Terms) -> tuple[dict[str, Span], Span]:
    """The days each count covers, for a report about `day`, and those that put an agent into the calendar set.

    The calendar set ends on `day`. The fiscal set does not, so its month may reach beyond `day`. The month is taken in
    `run_year` (the year the report is made in); None takes the year of `day`.
    """
    known = Span(terms.launch, day)
    windows = to_date_windows(day, run_year)
    spans = {f"cal_{name}": w.cut(known) for name, w in windows.items()}
    spans |= {"btd": known, "tc_ytd": terms.year.cut(known)}
    spans |= {f"tc_{name}": w.cut(terms.quarter) for name, w in windows.items()}
    return spans, known


def agent_counts(
    registrations: DataFrame, agent: str, customer: str, approved: Column, day: date, run_year: int | None, terms: Terms
) -> DataFrame:
    """Per agent all counts for one day; NULL in the counts of a set the agent has no row in."""
    spans, known = report_spans(day, run_year, terms)
    rows = registrations.where(known.holds(approved) | terms.quarter.holds(approved))
    tests = {name: span.holds(approved) for name, span in spans.items()}
    sets = {"_cal": known.holds(approved), "_tc": terms.quarter.holds(approved)}
    return _blank_absent(conditional_distinct(rows, [agent], customer, tests, sets), [agent])


def agent_counts_by_day(
    registrations: DataFrame,
    agent: str,
    customer: str,
    approved: Column,
    days: Sequence[date],
    run_year: int | None,
    terms: Terms,
) -> DataFrame:
    """`agent_counts` for many days in one plan, with the day as `data_date`."""
    all_spans = {d: report_spans(d, run_year, terms) for d in days}
    known = Span(terms.launch, max(days))
    starts = {"d_1": DAY, "wtd": WEEK, "mtd": MONTH, "qtd": QUARTER}
    windows = {f"cal_{name}": Running(start, known) for name, start in starts.items()}
    windows |= {"btd": Running(None, known), "tc_ytd": Running(None, terms.year)}
    windows |= {f"tc_{name}": Running(start, terms.quarter) for name, start in starts.items()}
    sets = {"_cal": {d: s[1] for d, s in all_spans.items()}, "_tc": {d: terms.quarter for d in days}}
    ends = {d: s[0] for d, s in all_spans.items()}
    counts = distinct_by_day(registrations, agent, customer, approved, windows, ends, sets)
    return _blank_absent(counts, [agent, "data_date"])


def _blank_absent(counts: DataFrame, keys: list[str]) -> DataFrame:
    calendar = [F.when(F.col("_cal"), F.col(c)).alias(c) for c in CALENDAR]
    fiscal = [F.when(F.col("_tc"), F.col(c)).alias(c) for c in FISCAL]
    return counts.where(F.col("_cal") | F.col("_tc")).select(*keys, *calendar, *fiscal)


def center_type(branch_code: Column) -> Column:
    # Fixed values
    first = F.left(branch_code, F.lit(1))
    return (
        F.when(first == "F", "FUNCTION").when(first == "V", "BUSINESS UNIT").when(first == "C", "PAY CENTER").otherwise("BRANCH")
    )


def staff(eligible: DataFrame, info: DataFrame) -> DataFrame:
    """The latest list of eligible employees with their agent id and what is known of them."""
    listed = at_latest(eligible, "file_date").select(
        "employee_id",
        "employee_full_name",
        "branch_code",
        "branch_name",
        F.concat(F.lit("0"), "red_phone").alias("agentid"),
        center_type(F.col("branch_code")).alias("center_type"),
    )
    known = info.where(F.col("iscurrent") == 1).select(
        "employeeid",
        whole_years(F.col("dateofjoining"), F.col("effectivedate")).alias("serviceyears"),
        "dateofjoining",
        "gender",
        "dateofbirth",
        "phonenumber",
        "joblocationstate",
        "joblocationtownship",
    )
    return listed.join(known, F.col("employee_id") == F.col("employeeid"), "left")


def _open(registrations: DataFrame) -> DataFrame:
    return registrations.where(F.col("acc_status") != "Closed")


def _run_year(run_date: date | None, mtd_year: str) -> int | None:
    if mtd_year == "data":
        return None
    if run_date is None:
        raise ValueError("the month's year comes from run_date; pass it, or mtd_year='data'")
    return run_date.year


def acquisition_report(
    eligible: DataFrame,
    info: DataFrame,
    registrations: DataFrame,
    data_date: date,
    run_date: date | None = None,
    terms: Terms = Terms(),
    mtd_year: str = "run",
) -> DataFrame:
    """The report made for `data_date`, about the day before it."""
    day = data_date - timedelta(days=1)
    counts = agent_counts(
        _open(registrations), "org_short_code", "cust_id", F.col("approval_date"), day, _run_year(run_date, mtd_year), terms
    )
    people = staff(eligible, info)
    return people.join(counts, F.col("agentid") == F.col("org_short_code"), "left").select(COLUMNS)


def acquisition_range(
    eligible: DataFrame,
    info: DataFrame,
    registrations: DataFrame,
    first: date,
    last: date,
    run_date: date | None = None,
    terms: Terms = Terms(),
    mtd_year: str = "run",
) -> DataFrame:
    """The reports for every data date first..last in one plan; `data_date` is the day reported on."""
    days = [first + timedelta(days=i - 1) for i in range((last - first).days + 1)]
    counts = agent_counts_by_day(
        _open(registrations), "org_short_code", "cust_id", F.col("approval_date"), days, _run_year(run_date, mtd_year), terms
    )
    each_day = F.explode(F.sequence(F.lit(days[0]), F.lit(days[-1])))
    people = staff(eligible, info).withColumn("report_date", each_day)  # the report has a row per person and day
    match = (F.col("agentid") == F.col("org_short_code")) & (F.col("report_date") == F.col("data_date"))
    return people.join(counts, match, "left").select(F.col("report_date").alias("data_date"), *COLUMNS)

"""Reports against plain Python, with days at edges of week, month, quarter and year."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakeops.functions.dates import Span, local_day, month_span, to_date_windows, week_start
from lakeops.operators.counts import conditional_distinct
from lakeops.plans.acquisition import CALENDAR, FISCAL, Terms, agent_counts, agent_counts_by_day, acquisition_report, report_spans
from lakeops.plans.close_status import close_status, stamp_snapshot

TERMS = Terms(date(2023, 10, 1), Span(date(2024, 11, 3), date(2025, 2, 2)), Span(date(2024, 11, 3), date(2025, 11, 2)))
DAYS = [date(2024, 12, 31), date(2025, 1, 1), date(2025, 1, 4), date(2025, 1, 5), date(2025, 1, 31), date(2025, 4, 1)]


def bag(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.fixture(scope="module")
def registrations():
    rng = random.Random(1)
    rows = []
    for _ in range(600):
        agent = rng.choice(["A", "A", "A", "B", "C"])
        customer = None if rng.random() < 0.05 else rng.randint(1, 60)
        rows.append((agent, customer, date(2024, 9, 1) + timedelta(days=rng.randint(0, 240))))
    return rows + [("only null", None, date(2024, 12, 1)), ("late", 1, date(2025, 2, 1)), ("early", 1, date(2023, 1, 1))]


def brute(rows, day, run_year):
    spans, known = report_spans(day, run_year, TERMS)
    out = []
    for agent in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == agent]
        sets = {}
        for names, span in ((CALENDAR, known), (FISCAL, TERMS.quarter)):
            inside = [r for r in mine if span.first <= r[2] <= span.last]
            for n in names:
                s = spans[n]
                ids = {r[1] for r in inside if r[1] is not None and s.first <= r[2] <= s.last}
                sets[n] = len(ids) if inside else None
        if any(v is not None for v in sets.values()):
            out.append((agent, *[sets[n] for n in [*CALENDAR, *FISCAL]]))
    return out


SCHEMA = "agent string, customer int, approved date"


@pytest.mark.parametrize("day", DAYS)
@pytest.mark.parametrize("run_year", [2024, 2025, None])
def test_counts_of_a_day(spark, registrations, day, run_year):
    got = agent_counts(
        spark.createDataFrame(registrations, SCHEMA), "agent", "customer", F.col("approved"), day, run_year, TERMS
    ).select("agent", *CALENDAR, *FISCAL)
    assert bag(got.collect()) == bag(brute(registrations, day, run_year))


@pytest.mark.parametrize("run_year", [2025, None])
def test_counts_by_day(spark, registrations, run_year):
    got = agent_counts_by_day(
        spark.createDataFrame(registrations, SCHEMA), "agent", "customer", F.col("approved"), DAYS, run_year, TERMS
    ).select("data_date", "agent", *CALENDAR, *FISCAL)
    want = [(d, *row) for d in DAYS for row in brute(registrations, d, run_year)]
    assert bag(got.collect()) == bag(want)


def test_windows():
    assert week_start(date(2025, 1, 5)) == date(2025, 1, 5)
    assert week_start(date(2025, 1, 4)) == date(2024, 12, 29)
    assert month_span(2024, 2) == Span(date(2024, 2, 1), date(2024, 2, 29))
    assert month_span(2024, 12).last == date(2024, 12, 31)
    assert to_date_windows(date(2025, 1, 1), 2024)["mtd"] == month_span(2024, 1)


def test_local_day():
    assert local_day(datetime(2024, 1, 1, 17, 29)) == date(2024, 1, 1)
    assert local_day(datetime(2024, 1, 1, 17, 30)) == date(2024, 1, 2)


def test_many_conditions(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("k"), (F.col("id") % 50).alias("v"), "id")
    tests = {f"c{i}": F.col("id") % 70 == i for i in range(70)}
    got = conditional_distinct(df, ["k"], "v", tests)
    want = df.groupBy("k").agg(*[F.count_distinct(F.when(t, F.col("v"))).alias(n) for n, t in tests.items()])
    assert bag(got.select("k", *tests).collect()) == bag(want.collect())


def test_agents_without_customers_have_null(spark):
    eligible = spark.createDataFrame(
        [("1", "Ann", "F01", "Main", "91", date(2025, 1, 1)), ("2", "Bob", "X01", "Side", "92", date(2025, 1, 1)), ("3", "Old", "C1", "x", "93", date(2024, 1, 1))],
        "employee_id string, employee_full_name string, branch_code string, branch_name string, red_phone string, file_date date",
    )
    info = spark.createDataFrame(
        [("1", date(2020, 3, 1), date(2025, 2, 28), "F", date(1990, 1, 1), "n", "09", "S", "T", 1)],
        "employeeid string, dateofjoining date, effectivedate date, gender string, dateofbirth date, nationalityid string, phonenumber string, joblocationstate string, joblocationtownship string, iscurrent int",
    )
    registrations = spark.createDataFrame(
        [("091", 1, date(2025, 1, 10), "Active"), ("091", 2, date(2025, 1, 10), "Closed"), ("091", 3, date(2025, 1, 10), None)],
        "org_short_code string, cust_id int, approval_date date, acc_status string",
    )
    got = {r["employee_id"]: r for r in acquisition_report(eligible, info, registrations, date(2025, 1, 11), date(2025, 1, 11), TERMS).collect()}
    assert set(got) == {"1", "2"}
    assert (got["1"]["cal_d_1"], got["1"]["tc_d_1"], got["1"]["serviceyears"], got["1"]["center_type"]) == (1, 1, 4, "FUNCTION")
    assert (got["2"]["cal_d_1"], got["2"]["btd"], got["2"]["center_type"]) == (None, None, "BRANCH")
    with pytest.raises(ValueError):
        acquisition_report(eligible, info, registrations, date(2025, 1, 11))


@pytest.mark.parametrize("done,expected", [([1, 2], "complete"), ([1], "incomplete"), ([], None)])
def test_close_status(spark, done, expected):
    today = date(2025, 3, 26)
    branches = spark.createDataFrame([(1, "O"), (2, "O"), (3, "C")], "branch_code int, record_stat string")
    dates = spark.createDataFrame([(today,), (today - timedelta(1),)], "today date")
    stages = spark.createDataFrame(
        [(b, today, "POSTEOPD_3", "C") for b in done] + [(2, today, "POSTEOPD_3", "W"), (2, today - timedelta(1), "POSTEOPD_3", "C")],
        "branch_code int, branch_date date, target_stage string, eoc_status string",
    )
    runs = spark.createDataFrame(
        [(today, "POSTEOPD_3", "C", datetime(2025, 3, 26, 23, h), datetime(2025, 3, 26, 23, h + 1)) for h in (5, 1)],
        "branch_date date, eoc_stage string, eoc_stage_status string, start_time timestamp, end_time timestamp",
    )
    got = close_status(branches, dates, stages, runs).collect()
    assert [r["status"] for r in got] == ([expected] if expected else [])
    if expected:
        assert (got[0]["start_time"].minute, got[0]["end_time"].minute) == (1, 6)
    [zero] = close_status(branches, dates, stages, runs, emit_zero=True).collect()
    assert zero["no_of_eoc_branch"] == len(done) and zero["branch_date"] == today
    [stamped] = stamp_snapshot(close_status(branches, dates, stages, runs, emit_zero=True), datetime(2025, 3, 26, 17, 45)).collect()
    assert (stamped["day_key"], stamped["hh_mm"]) == ("20250327", "0015")

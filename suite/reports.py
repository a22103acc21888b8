"""Reports: acquisition, close of day, extracts."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.dates import Span, to_date_windows
from lakeops.operators.counts import conditional_distinct
from lakeops.operators.rows import any_row, status_gate
from lakeops.plans.acquisition import Terms, acquisition_range, acquisition_report
from lakeops.plans.close_status import close_status as close_of_day
from lakeops.plans.extracts import payroll_extract as payroll
from suite.registry import day_text, plain, query, stamp_text, table

AS_OF = date(2000, 5, 17)
LAUNCH = date(1997, 10, 1)


@query(
    """
    SELECT o_custkey % 100 AS agent,
           count(DISTINCT CASE WHEN d = DATE '2000-05-17' THEN o_custkey END) AS d_1,
           count(DISTINCT CASE WHEN d BETWEEN DATE '2000-05-17' - dayofweek(DATE '2000-05-17')::INT AND DATE '2000-05-17'
                               THEN o_custkey END) AS wtd,
           count(DISTINCT CASE WHEN month(d) = 5 AND year(d) = 2000 THEN o_custkey END) AS mtd,
           count(DISTINCT CASE WHEN d BETWEEN date_trunc('quarter', DATE '2000-05-17') AND DATE '2000-05-17'
                               THEN o_custkey END) AS qtd,
           count(DISTINCT CASE WHEN d BETWEEN DATE '1997-10-01' AND DATE '2000-05-17' THEN o_custkey END) AS btd
    FROM (SELECT o_custkey, o_orderdate::DATE AS d FROM orders)
    WHERE d BETWEEN DATE '1997-10-01' AND DATE '2000-05-17'
    GROUP BY 1
    """
)
def acquisition_windows(spark: SparkSession, sf: str) -> DataFrame:
    known = Span(LAUNCH, AS_OF)
    at = F.col("o_orderdate")
    rows = table(spark, sf, "orders").where(known.holds(at)).select(
        (F.col("o_custkey") % 100).alias("agent"), "o_custkey", "o_orderdate"
    )
    spans = {**to_date_windows(AS_OF, AS_OF.year), "btd": known}
    tests = {name: span.holds(at) for name, span in spans.items()}
    return conditional_distinct(rows, ["agent"], "o_custkey", tests)


TERMS = Terms(date(1998, 1, 1), Span(date(2000, 1, 3), date(2000, 4, 2)), Span(date(2000, 1, 3), date(2001, 1, 2)))

#: One row per person, from the supplier alone: the later of the two lists, and what is known of four out of five.
STAFF_SQL = """
    staff AS (
        SELECT s_suppkey::VARCHAR AS employee_id, s_name AS employee_full_name, '0' || s_suppkey::VARCHAR AS agentid, s_suppkey % 5 <> 0 AS known,
               ['F', 'V', 'C', 'B'][(s_nationkey % 4)::INT + 1] || s_nationkey::VARCHAR AS branch_code, 'Branch ' || s_nationkey::VARCHAR AS branch_name,
               ['FUNCTION', 'BUSINESS UNIT', 'PAY CENTER', 'BRANCH'][(s_nationkey % 4)::INT + 1] AS center_type,
               CASE WHEN known THEN '09' || s_suppkey::VARCHAR END AS phonenumber, CASE WHEN known THEN ['F', 'M'][(s_suppkey % 2)::INT + 1] END AS gender,
               CASE WHEN known THEN strftime(DATE '1960-01-01' + (s_suppkey * 11 % 9000)::INT, '%Y-%m-%d') END AS dateofbirth,
               CASE WHEN known THEN strftime(DATE '1980-01-01' + (s_suppkey * 37 % 7000)::INT, '%Y-%m-%d') END AS dateofjoining,
               CASE WHEN known THEN datesub('year', DATE '1980-01-01' + (s_suppkey * 37 % 7000)::INT, DATE '2000-12-31')::INT END AS serviceyears,
               CASE WHEN known THEN n_name END AS joblocationstate, CASE WHEN known THEN n_name || ' township' END AS joblocationtownship
        FROM supplier JOIN nation ON s_nationkey = n_nationkey)
"""

#: Every period of every day as a row of its bounds, within what a scope covers; customers are counted once for all of them.
WINDOWS_SQL = """
    spans AS (
        SELECT e, scope.name || '_' || period.name AS span, greatest(period.first, scope.first) AS first, least(period.last, scope.last) AS last
        FROM (SELECT e, unnest([
                {'name': 'd_1', 'first': e, 'last': e},
                {'name': 'wtd', 'first': e - dayofweek(e)::INT, 'last': e},
                {'name': 'mtd', 'first': make_date(2000, month(e), 1), 'last': last_day(make_date(2000, month(e), 1))},
                {'name': 'qtd', 'first': date_trunc('quarter', e)::DATE, 'last': e},
                {'name': 'year', 'first': DATE '2000-01-03', 'last': DATE '2001-01-02'},
                {'name': 'all', 'first': DATE '1900-01-01', 'last': DATE '2100-01-01'}]) AS period FROM days)
        JOIN (SELECT e AS day_of, unnest([
                {'name': 'cal', 'first': DATE '1998-01-01', 'last': e},
                {'name': 'tc', 'first': DATE '2000-01-03', 'last': DATE '2000-04-02'}]) AS scope FROM days) ON e = day_of),
    seen AS (SELECT DISTINCT '0' || l_suppkey::VARCHAR AS agent, l_partkey AS customer, l_shipdate::DATE AS day FROM lineitem WHERE l_returnflag <> 'R' AND l_tax <> 0),
    counted AS (SELECT e, agent, span, count(DISTINCT customer) AS n FROM seen JOIN spans ON day BETWEEN first AND last GROUP BY ALL),
    by_span AS (SELECT e, agent, map_from_entries(list((span, n))) AS n FROM counted GROUP BY ALL),
    report AS (
        SELECT days.e, staff.* EXCLUDE (known),
               CASE WHEN n['tc_all'] > 0 THEN coalesce(n['tc_d_1'], 0) END AS tc_d_1, CASE WHEN n['tc_all'] > 0 THEN coalesce(n['tc_wtd'], 0) END AS tc_wtd,
               CASE WHEN n['tc_all'] > 0 THEN coalesce(n['tc_mtd'], 0) END AS tc_mtd, CASE WHEN n['tc_all'] > 0 THEN coalesce(n['tc_qtd'], 0) END AS tc_qtd,
               n['cal_all'] AS btd, CASE WHEN n['cal_all'] > 0 THEN coalesce(n['cal_year'], 0) END AS tc_ytd,
               CASE WHEN n['cal_all'] > 0 THEN coalesce(n['cal_d_1'], 0) END AS cal_d_1, CASE WHEN n['cal_all'] > 0 THEN coalesce(n['cal_wtd'], 0) END AS cal_wtd,
               CASE WHEN n['cal_all'] > 0 THEN coalesce(n['cal_mtd'], 0) END AS cal_mtd, CASE WHEN n['cal_all'] > 0 THEN coalesce(n['cal_qtd'], 0) END AS cal_qtd
        FROM staff CROSS JOIN days LEFT JOIN by_span ON agent = agentid AND by_span.e = days.e)
"""


def employees(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    supplier, nation = table(spark, sf, "supplier"), table(spark, sf, "nation")
    key = F.col("s_suppkey")
    text = key.cast("string")
    eligible = supplier.select(
        text.alias("employee_id"),
        F.col("s_name").alias("employee_full_name"),
        F.expr("concat(substr('FVCB', s_nationkey % 4 + 1, 1), s_nationkey)").alias("branch_code"),
        F.concat(F.lit("Branch "), "s_nationkey").alias("branch_name"),
        text.alias("red_phone"),
        F.explode(F.array(F.lit(date(2000, 1, 1)), F.lit(date(2000, 2, 1)))).alias("file_date"),
    )
    info = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        text.alias("employeeid"),
        F.date_add(F.lit(date(1980, 1, 1)), (key * 37 % 7000).cast("int")).alias("dateofjoining"),
        F.lit(date(2000, 12, 31)).alias("effectivedate"),
        F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
        F.date_add(F.lit(date(1960, 1, 1)), (key * 11 % 9000).cast("int")).alias("dateofbirth"),
        F.concat(F.lit("09"), text).alias("phonenumber"),
        F.col("n_name").alias("joblocationstate"),
        F.concat("n_name", F.lit(" township")).alias("joblocationtownship"),
        F.when(key % 5 == 0, 0).otherwise(1).alias("iscurrent"),
    )
    registrations = table(spark, sf, "lineitem").select(
        F.concat(F.lit("0"), F.col("l_suppkey").cast("string")).alias("org_short_code"),
        F.col("l_partkey").alias("cust_id"),
        F.col("l_shipdate").alias("approval_date"),
        F.when(F.col("l_returnflag") == "R", "Closed").when(F.col("l_tax") == 0, None).otherwise("Active").alias("acc_status"),
    )
    return eligible, info, registrations


@query(
    f"WITH days AS (SELECT DATE '2000-03-15' AS e), {STAFF_SQL}, {WINDOWS_SQL} SELECT * EXCLUDE (e) FROM report"
)
def acquisition_report_day(spark: SparkSession, sf: str) -> DataFrame:
    return plain(acquisition_report(*employees(spark, sf), date(2000, 3, 16), date(2000, 3, 16), TERMS))


@query(
    f"""
    WITH days AS (SELECT unnest(generate_series(DATE '2000-03-28', DATE '2000-04-03', INTERVAL 1 DAY))::DATE AS e),
    {STAFF_SQL}, {WINDOWS_SQL}
    SELECT * EXCLUDE (e), {day_text('e')} AS data_date FROM report
    """
)
def acquisition_by_day(spark: SparkSession, sf: str) -> DataFrame:
    frames = employees(spark, sf)
    return plain(acquisition_range(*frames, date(2000, 3, 29), date(2000, 4, 4), date(2000, 4, 4), TERMS))


def close_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    events = table(spark, sf, "events")
    day = F.to_date("ts")
    # each user is an open branch, and has a closed one beside it
    twins = F.array(
        F.struct(F.col("user_id").alias("branch_code"), F.lit("O").alias("record_stat")),
        F.struct((-F.col("user_id") - 1).alias("branch_code"), F.lit("X").alias("record_stat")),
    )
    branches = events.select(F.inline(twins))
    stages = events.select(
        F.col("user_id").alias("branch_code"),
        day.alias("branch_date"),
        F.col("event_type").alias("target_stage"),
        F.lit("C").alias("eoc_status"),
    )
    runs = events.select(
        day.alias("branch_date"),
        F.col("event_type").alias("eoc_stage"),
        F.lit("C").alias("eoc_stage_status"),
        F.col("ts").alias("start_time"),
        F.col("ts").alias("end_time"),
    )
    return branches, events.select(day.alias("today")), stages, runs


@query(
    f"""
    WITH e AS (SELECT *, ts::DATE AS d FROM events), m AS (SELECT max(d) AS today FROM e),
    total AS (SELECT count(DISTINCT user_id) AS t FROM e),
    done AS (SELECT d, count(DISTINCT user_id) AS n, min(ts) AS first_ts, max(ts) AS last_ts
             FROM e WHERE event_type = 'purchase' AND d = (SELECT today FROM m) GROUP BY d)
    SELECT {day_text('d')} AS branch_date, t AS no_of_total_branch, n AS no_of_eoc_branch,
           CASE WHEN t = n THEN 'complete' ELSE 'incomplete' END AS status,
           {stamp_text('first_ts')} AS start_time, {stamp_text('last_ts')} AS end_time
    FROM total, done
    """
)
def close_status(spark: SparkSession, sf: str) -> DataFrame:
    return plain(close_of_day(*close_tables(spark, sf), stage="purchase"))


@query(
    f"""
    SELECT {day_text('(SELECT max(ts)::DATE FROM events)')} AS branch_date, count(DISTINCT user_id) AS no_of_total_branch,
           0::BIGINT AS no_of_eoc_branch, 'incomplete' AS status,
           NULL::VARCHAR AS start_time, NULL::VARCHAR AS end_time
    FROM events
    """
)
def close_status_none_done(spark: SparkSession, sf: str) -> DataFrame:
    return plain(close_of_day(*close_tables(spark, sf), stage="no such stage", emit_zero=True))


@query(
    """
    WITH s AS (SELECT o_orderdate::DATE AS d, o_orderstatus = 'F' AS done FROM orders)
    SELECT 'on or after' AS variant, coalesce(bool_or(done AND d >= DATE '2001-08-01'), false) AS is_open FROM s
    UNION ALL SELECT 'on', coalesce(bool_or(done AND d = DATE '2001-08-01'), false) FROM s
    UNION ALL SELECT 'before', coalesce(bool_or(done AND d < DATE '2001-08-01'), false) FROM s
    UNION ALL SELECT 'after the end', coalesce(bool_or(done AND d >= DATE '2001-08-02'), false) FROM s
    """
)
def status_gates(spark: SparkSession, sf: str) -> DataFrame:
    status = table(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("branch_date"),
        F.when(F.col("o_orderstatus") == "F", "complete").otherwise("incomplete").alias("status"),
    )
    end = date(2001, 8, 1)
    wanted = [("on or after", ">=", end), ("on", "==", end), ("before", "<", end), ("after the end", ">=", end + timedelta(1))]
    out = None
    for variant, op, day in wanted:
        one = status_gate(status, F.lit(day), op).select(F.lit(variant).alias("variant"), "is_open")
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT count(*) > 0 AS found FROM events WHERE ts >= DATE '2024-01-17' AND ts < DATE '2024-01-18'")
def day_present(spark: SparkSession, sf: str) -> DataFrame:
    day = date(2024, 1, 17)
    return any_row(table(spark, sf, "events"), Span(day, day).holds(F.col("ts")))


@query(
    """
    SELECT strftime(o_orderdate, '%Y%m') AS payroll_month, strftime(o_orderdate, '%Y%m') AS bal_month,
           (o_custkey % 50)::VARCHAR AS employer_short_code, 'Employer ' || (o_custkey % 50)::VARCHAR AS employer_name,
           c_custkey::VARCHAR AS employee_id, c_name AS employee_name, o_orderpriority AS channel,
           CASE WHEN o_totalprice > 200000 THEN 'Y' ELSE 'N' END AS has_pay_adv, o_orderstatus AS account_status,
           c_nationkey::VARCHAR AS cust_region, CASE WHEN c_acctbal > 0 THEN 'Y' ELSE 'N' END AS is_bank_acc_link,
           c_acctbal AS avgerage_balance
    FROM orders JOIN customer ON o_custkey = c_custkey
    """
)
def payroll_extract(spark: SparkSession, sf: str) -> DataFrame:
    month = F.date_format("o_orderdate", "yyyyMM")
    employer = (F.col("o_custkey") % 50).cast("string")
    joined = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return payroll(
        joined.select(
            month.alias("payroll_month"),
            month.alias("bal_month"),
            employer.alias("employer_short_code"),
            F.concat(F.lit("Employer "), employer).alias("employer_name"),
            F.col("c_custkey").cast("string").alias("employee_id"),
            F.col("c_name").alias("employee_name"),
            F.col("o_orderpriority").alias("channel"),
            F.when(F.col("o_totalprice") > 200000, "Y").otherwise("N").alias("has_pay_adv"),
            F.col("o_orderstatus").alias("account_status"),
            F.col("c_nationkey").cast("string").alias("cust_region"),
            F.when(F.col("c_acctbal") > 0, "Y").otherwise("N").alias("is_bank_acc_link"),
            F.col("c_acctbal").alias("avgerage_balance"),
            "o_orderkey",
        )
    )

"""Close of day: how many open branches have passed the last stage on the latest business date."""

from __future__ import annotations

from datetime import datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions.dates import ZONE
from lakeops.operators.rows import at_latest, beside

# The last stage, the code for done, the code for an open branch.
LAST_STAGE = "POSTEOPD_3"
DONE = "C"
OPEN = "O"


def close_status(
    branches: DataFrame,
    business_dates: DataFrame,
    stages: DataFrame,
    run_chart: DataFrame,
    stage: str = LAST_STAGE,
    emit_zero: bool = False,
) -> DataFrame:
    """branch_date, no_of_total_branch, no_of_eoc_branch, status, start_time, end_time.

    No row while no branch is done; `emit_zero` gives a row with zero, status incomplete and open times instead.
    """
    total = branches.where(F.col("record_stat") == OPEN).agg(F.count_distinct("branch_code").alias("no_of_total_branch"))
    today = business_dates.agg(F.max("today").alias("today"))
    passed = stages.where((F.col("target_stage") == stage) & (F.col("eoc_status") == DONE))
    done = (
        at_latest(passed, "branch_date", today, "today")
        .groupBy("branch_date")
        .agg(F.count_distinct("branch_code").alias("no_of_eoc_branch"))
    )
    runs = run_chart.where((F.col("eoc_stage") == stage) & (F.col("eoc_stage_status") == DONE))
    times = (
        at_latest(runs, "branch_date", today, "today")
        .groupBy("branch_date")
        .agg(F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"))
    )
    counted = beside(total, done, emit_zero)
    if emit_zero:
        counted = counted.crossJoin(F.broadcast(today)).withColumns(
            {
                "branch_date": F.coalesce("branch_date", "today"),
                "no_of_eoc_branch": F.coalesce("no_of_eoc_branch", F.lit(0).cast("bigint")),
            }
        )
    complete = F.col("no_of_total_branch") == F.col("no_of_eoc_branch")
    return counted.join(times, "branch_date", "left" if emit_zero else "inner").select(
        "branch_date",
        "no_of_total_branch",
        "no_of_eoc_branch",
        F.when(complete, "complete").otherwise("incomplete").alias("status"),
        "start_time",
        "end_time",
    )


def stamp_snapshot(status: DataFrame, as_of: datetime, zone: str = ZONE) -> DataFrame:
    """Add inserted_time, the day keys and hh_mm of the instant the status was taken, in local time."""
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    local = as_of.astimezone(ZoneInfo(zone))
    text = F.lit(local.strftime("%Y-%m-%d %H:%M:%S"))
    return status.withColumns(
        {
            "inserted_time": F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")),
            "year_key": F.lit(local.strftime("%Y")),
            "month_key": F.lit(local.strftime("%Y%m")),
            "day_key": F.lit(local.strftime("%Y%m%d")),
            "hh_mm": F.lit(local.strftime("%H%M")),
        }
    )

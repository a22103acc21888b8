"""Extracts for consumers and the officer list."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.mapping import Field, map_columns
from lakeops.sinks.export import export_csv, export_single_csv
from lakeops.sources.files import read_table
from lakeops.sources.folder import only_days

# Column names of the extracts.
PAYROLL_COLUMNS = [
    "payroll_month",
    "bal_month",
    "employer_short_code",
    "employer_name",
    "employee_id",
    "employee_name",
    "channel",
    "has_pay_adv",
    "account_status",
    "cust_region",
    "is_bank_acc_link",
    "avgerage_balance",
]
OFFICER_FIELDS = [
    Field("Employee Id", "employee_id"),
    Field("Name", "name"),
    Field("Email Address", "email_address"),
    Field("Department", "department"),
    Field("User Group", "user_group"),
    Field("User Status", "user_status"),
]


def payroll_extract(balances: DataFrame) -> DataFrame:
    return balances.select(PAYROLL_COLUMNS)


def dated_name(stem: str, day: date) -> str:
    return f"{stem}_{day:%Y-%m-%d}"


def export_payroll(balances: DataFrame, folder: str, day: date) -> str:
    """The payroll extract as one CSV in a folder named for the day; returns the folder."""
    path = f"{folder}/{dated_name('payroll', day)}"
    export_single_csv(payroll_extract(balances), path)
    return path


def export_transactions(spark: SparkSession, table: str, first: str, last: str, folder: str, day: date, rows_per_file: int) -> str:
    """The days first..last of a transaction table as CSV parts of bounded size in a folder named for the day; returns
    the folder. Only the partitions asked for are read, and parts are written where the rows are."""
    path = f"{folder}/{dated_name('transactions', day)}"
    export_csv(only_days(read_table(spark, table), first, last), path, rows_per_file)
    return path


def officer_list(rows: DataFrame, data_date: date) -> DataFrame:
    """Renamed, trimmed, and dated with the local day of the load (see `local_day`)."""
    named = map_columns(rows, OFFICER_FIELDS)
    return named.select(*[F.trim(c).alias(c) for c in named.columns], F.lit(data_date).alias("data_date"))

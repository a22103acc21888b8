"""The daily feeds: how each is named and read, and what its columns become."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.jsoncols import list_text
from lakeops.functions.names import distinct_names, rename_all, snake, squeeze, underscore
from lakeops.functions.text import each_string, one_line
from lakeops.operators.mapping import Field, add_missing, check_columns, find_source, map_columns, unfit
from lakeops.operators.repair import LOG, clean_log
from lakeops.session import materialize, path_exists
from lakeops.sinks.tables import KEYS, overwrite, replace_days
from lakeops.sources.delimited import Named, by_heading, line_records, quoted_records
from lakeops.sources.files import read_excel, read_lines, read_raw_lines
from lakeops.sources.folder import Naming, latest_per_day, list_files, paths_of, stamp_keys


@dataclass(frozen=True)
class Feed:
    """`rows` makes rows with `file_name` of the feed's lines (or `read` of its files, where they are no text); `fields`
    type them; `after` is applied last. `line_end` is what ends a line, None for any kind."""

    naming: Naming
    rows: Callable[[DataFrame, tuple[Field, ...]], DataFrame | Named] | None
    fields: tuple[Field, ...]
    after: Callable[[DataFrame], DataFrame] = field(default=lambda df: df)
    line_end: str | None = "\n"
    read: Callable[[SparkSession, list[str]], DataFrame] | None = None


def read_rows(spark: SparkSession, feed: Feed, paths: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """Files of a feed as untyped rows with file_name, and what is known of their headings, if the feed has any."""
    if feed.rows is None:
        return feed.read(spark, paths), None
    rows = feed.rows((read_lines if feed.line_end is None else read_raw_lines)(spark, paths), feed.fields)
    return (rows.rows, rows.heads) if isinstance(rows, Named) else (rows, None)


def process(spark: SparkSession, feed: Feed, paths: list[str]) -> DataFrame:
    """Files of a feed as typed rows with file_name and day keys."""
    return shape(feed, read_rows(spark, feed, paths)[0])


def shape(feed: Feed, rows: DataFrame, also: Sequence[Column] = ()) -> DataFrame:
    keyed = stamp_keys(rows, feed.naming)
    type = "int" if feed.naming.as_int else "string"
    extra = [Field("file_name", "file_name"), *[Field(k, k, type) for k in KEYS]]
    return feed.after(map_columns(keyed, [*feed.fields, *extra], missing="null", also=also))


def aside(table: str, what: str) -> str:
    """Where an ingest into `table` tells of its `files` (the ledger), of files that are `undated` or `headless`, and of
    `unparsed` cells."""
    return f"{table.rstrip('/')}_aside/{what}"


LEDGER = "file_path string, file_name string, day_key string, state string, n_rows long, load string"
UNPARSED = "file_name string, column string, n long"


def held_days(spark: SparkSession, table: str, load: str) -> DataFrame:
    """(day_key, _held): the file that a day of the table came from, by the ledger of all loads but this one."""
    if not path_exists(spark, aside(table, "files")):
        return spark.createDataFrame([], "day_key string, _held string")
    ledger = spark.read.schema(LEDGER).parquet(aside(table, "files"))
    return ledger.where((F.col("state") == "taken") & (F.col("load") != load)).groupBy("day_key").agg(F.max("file_name").alias("_held"))


def load_files(spark: SparkSession, feed: Feed, files: DataFrame, table: str, load: str, held: DataFrame | None = None) -> dict[str, DataFrame]:
    """Put the days of some files (file_path, file_name, day_key) into the table, and tell what became of each in its ledger.

    Of several files for a day the greatest name counts, and none that is less than the one held. Text is read at most twice:
    for the headings and for the rows. How many rows each file gave, and how many of its cells did not fit their types,
    is counted by the write itself. The ledger of a load is written last, so one that broke off is done again as a whole.
    Returns what is to be told aside, where there is any: files `undated` and `headless`, cells `unparsed`.
    """
    best = latest_per_day(files)
    if held is not None:
        best = best.join(held, "day_key", "left").where(F.col("_held").isNull() | (F.col("file_name") >= F.col("_held")))
    # the list of files that Spark's driver holds for any scan of them
    chosen = {int(r["day_key"]): r for r in best.select("day_key", "file_path", "file_name").collect()}
    seen: dict[str, dict[int, int]] = {}
    headed = None
    typed: list[Field] = []
    if chosen:
        rows, heads = read_rows(spark, feed, sorted(r["file_path"] for r in chosen.values()))
        headed = None if heads is None else {r["file_name"] for r in heads.where("n_named > 0").select("file_name").collect()}
        typed = [f for f in feed.fields if f.type != "string" and find_source(rows, f) is not None]
        bits = [F.when(unfit(rows, f), F.lit(1 << k)).otherwise(0) for k, f in enumerate(typed)]
        unfit_bits = sum(bits, F.lit(0).cast("long")).alias("_unfit")
        # a day has one file here; a histogram with a bin for each day counts exactly
        day, bins = F.col("day_key").cast("int"), F.lit(len(chosen) + 1)
        per_day = {"rows": F.histogram_numeric(day, bins)}
        per_day |= {f.target: F.histogram_numeric(F.when(F.col("_unfit").bitwiseAND(1 << k) != 0, day), bins) for k, f in enumerate(typed)}
        told = replace_days(shape(feed, rows, also=[unfit_bits]), table, measures=per_day, aside=("_unfit",))
        seen = {name: {int(b["x"]): int(b["y"]) for b in found or []} for name, found in told.items()}
    fate = [(r["file_path"], "taken" if headed is None or r["file_name"] in headed else "headless", seen["rows"].get(d, 0)) for d, r in chosen.items()]
    unparsed = [(chosen[d]["file_name"], f.target, n) for f in typed for d, n in seen[f.target].items()]
    known = spark.createDataFrame(fate, "file_path string, _state string, n_rows long")
    state = F.when(F.col("day_key").isNull(), "undated").otherwise(F.coalesce("_state", F.lit("superseded"))).alias("state")
    ledger = files.join(known, "file_path", "left").select("file_path", "file_name", F.col("day_key").cast("string").alias("day_key"), state, "n_rows", F.lit(load).alias("load"))
    ledger.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load").parquet(aside(table, "files"))
    left_out = {"undated": files.where("day_key IS NULL").select("file_path", "file_name"), "unparsed": spark.createDataFrame(unparsed, UNPARSED)}
    headless = [(path, path.rsplit("/", 1)[-1]) for path, what, _ in fate if what == "headless"]
    return {**left_out, "headless": spark.createDataFrame(headless, "file_path string, file_name string")}


def ingest(spark: SparkSession, feed: Feed, source: str, table: str) -> None:
    """All files below `source` into the table, one job; each file's day is replaced as a whole.

    Files whose names hold no valid date, files without a heading, and counts of cells that did not fit their types are told
    in tables beside it (see `aside`).
    """
    files = materialize(list_files(spark, source, feed.naming), "files")
    for what, rows in load_files(spark, feed, files, table, "all").items():
        overwrite(rows, aside(table, what))


def _csv(lines: DataFrame, fields: tuple[Field, ...]) -> Named:
    rows, heads = line_records(lines)
    return by_heading(rows, fields, heads)


def _fields(headings: Sequence[str], special: dict[str, Field] | None = None) -> tuple[Field, ...]:
    """One string field per heading, found as written or with `_` for every special character, called by the latter
    with runs of `_` as one. `special` overrides by heading."""
    out = []
    for h in headings:
        target = "_".join(p for p in underscore(h).split("_") if p)
        out.append((special or {}).get(h) or Field((h, underscore(h), target), target))
    return tuple(out)


# Headings and formats of the feeds.
TRANSACTIONS = Feed(
    Naming(pattern=r"_(\d{8})\.[^.]*$", fmt="ddMMyyyy", glob="*.csv"),
    _csv,
    _fields(
        (
            "Transaction ID",
            "Status",
            "Initiation time",
            "Last update time",
            "Transaction type",
            "Reason type",
            "Initiator",
            "Initiator type",
            "Requester",
            "Requester type",
            "Channel",
            "Amount",
            "Debit Party Charge",
            "Debit Party Commission",
            "Credit Party Charge",
            "Credit Party Commission",
            "Failure description",
            "Debit Party",
            "Debit Party Type",
            "Credit Party",
            "Credit Party Type",
            "Account entries",
            "Ref Data",
            "Link transaction ID",
            "Approver",
            "Approver type",
            "Approver time",
            "ConversationID",
            "OriginatorConversationID",
            "Credit_Customer_ID",
            "Debit_Customer_ID",
            "Cost(Principle Commission)",
            "Cost(Residual Commission)",
            "Revenue(Service Fee)",
            "SettlementService Type",
            "3rd_party_charge",
            "original_order_id",
        ),
        {
            "Initiation time": Field("Initiation time", "initiation_time", "timestamp", "yyyyMMddHHmmss"),
            "Last update time": Field("Last update time", "last_update_time", "timestamp", "yyyyMMddHHmmss"),
            "ConversationID": Field("ConversationID", "conversation_id"),
            "OriginatorConversationID": Field("OriginatorConversationID", "originator_conversation_id"),
            "SettlementService Type": Field("SettlementService Type", "settlement_service_type"),
            "3rd_party_charge": Field("3rd_party_charge", "third_party_charge"),
        },
    ),
)

CUSTOMERS = Feed(
    Naming(pattern=r"_(\d{8})\.[^.]*$", fmt="ddMMyyyy", glob="*.csv"),
    _csv,
    _fields(
        (
            "phone no",
            "customer name",
            "customer nrc/passport",
            "level",
            "status",
            "date 1st login for one month",
            "no. of login for one month",
            "date registered",
            "date 1st login",
            "no. of login",
            "customer_id",
            "date of birth",
            "permanent address",
            "township",
            "state/division",
            "nationality",
            "gender",
            "town",
            "modifiedon",
            "casa flag",
            "email address",
            "primary id type",
            "secondary id type",
            "sub trust level",
            "employment type",
            "segment",
            "customer trust level detail",
        ),
        {
            "level": Field(("level", "trust_level", "trust level"), "level"),
            "date registered": Field(
                ("date registered", "date_registered"), "date_registered", "timestamp", "yyyy/MM/dd HH:mm:ss"
            ),
        },
    ),
)

CATEGORIES = Feed(
    Naming(pattern=r"(\d{8})\.[^.]*$", fmt="yyyyMMdd", glob="*.csv"),
    _csv,
    _fields(
        (
            "level 1 category id",
            "level 1 category name",
            "level 2 category id",
            "level 2 category name",
            "level 3 category id",
            "level 3 category name",
            "created user id",
            "created date",
            "status",
            "updated user id",
            "last updated date",
        ),
        {
            "created date": Field(("created date", "created_date"), "created_date", "timestamp"),
            "last updated date": Field(("last updated date", "last_updated_date"), "last_updated_date", "timestamp"),
        },
    ),
)


def _log(lines: DataFrame, fields: tuple[Field, ...]) -> DataFrame:
    return clean_log(lines)


LOGINS = Feed(
    Naming(pattern=r"(\d{8})\.[^.]*$", fmt="yyyyMMdd", glob="*.csv"),
    _log,
    (
        Field(LOG.id, "customer_id"),
        Field(LOG.phone, "phone_number"),
        Field(LOG.name, "customer_name"),
        Field(LOG.stamp, "login_time", "timestamp"),
        Field("source", "source"),
        Field("role", "role"),
    ),
    line_end=None,
)


def centers(brand: str) -> Feed:
    """The list of service centers; three of its headings carry the brand's name."""
    columns = (
        "center_code",
        f"{brand}_center_code",
        f"state_of_{brand}_center",
        f"township_of_{brand}_center",
        "center_open_date",
        "center_status",
        "center_status_start_date",
        "center_status_end_date",
        "center_size",
        "cash_out_start_date",
        "operating_hours",
        "operating_hours_change_start_date",
        "operating_hours_change_end_date",
        "service",
        "services_change_start_date",
        "services_change_end_date",
        "super_agent_short_code",
        "org_name",
        "retail_agent_short_code",
        "retail_short_code_change_start_date",
        "retail_short_code_change_end_date",
        "retail_agent_name",
        "retail_agent_joining_date",
        "remark",
    )

    def heading(name: Column, place: Column) -> Column:
        squeezed = F.lower(F.regexp_replace(F.trim(F.regexp_replace(name, "[\r\n]", "")), " ", ""))
        return F.when((place == 0) & (squeezed == ""), "center_code").otherwise(squeezed)

    def rows(lines: DataFrame, fields: tuple[Field, ...]) -> Named:
        # records are put together once, for the headings and for the rows
        named = by_heading(materialize(quoted_records(lines), "records"), fields[1:], rule=heading)
        cleaned = each_string(named.rows, one_line)
        return Named(cleaned.withColumn("datadate", F.regexp_extract("file_name", r"(\d{4}-\d{2}-\d{2})", 1)), named.heads)

    naming = Naming(pattern=r"(\d{4})-(\d{2})-(\d{2})\.[^.]*$", fmt="yyyyMMdd", shift=0, as_int=True, glob="*.csv")
    return Feed(naming, rows, (Field("datadate", "datadate"), *_fields(columns)))


FRAUD_DATES = ("fraud_incident_from_date", "fraud_incident_to_date", "fraud_discover_date", "fmu_fraud_discover_date")
FRAUD_COLUMNS = (
    "case_no",
    *FRAUD_DATES,
    "description",
    "how_detected",
    "ticket_number",
    "investigation_team",
    "fraud_category",
    "fraud_type",
    "initial_loss_amount_mmk",
    "recovery_amount_mmk",
    "net_loss_amount_mmk",
    "trends",
    "fraudster_group",
    "status",
    "status_update",
    "latest_update",
    "assigned_to_followup",
    "impact_phone",
    "first_related_phone",
    "second_related_phone",
    "third_related_phone",
    "fourth_related_phone",
    "fifth_related_phone",
    "sixth_related_phone",
    "seventh_related_phone",
    "eighth_related_phone",
    "fraud_pattern_name",
    "remark",
)
# one value in the first, lists in the others; further phone columns stay as they are
FRAUD_LISTS = {"impact_phone": True, "first_related_phone": False, "second_related_phone": False, "third_related_phone": False}


def phone_lists(df: DataFrame) -> DataFrame:
    """The phone cells as JSON lists."""
    return df.withColumns({c: list_text(F.col(c), f"{c}_json", single) for c, single in FRAUD_LISTS.items()})


def fraud_rows(sheet: DataFrame) -> DataFrame:
    """A case sheet, already tabular, with its columns checked."""
    rows = sheet.toDF(*distinct_names([squeeze(c) for c in sheet.columns]))
    return check_columns(rows, [*FRAUD_COLUMNS, "file_name"])


FRAUD_CASES = Feed(
    Naming(pattern=r"_(\d{8})\.xlsx$", fmt="yyyyMMdd", glob="*.xlsx"),
    None,
    tuple(Field(c, c, "date" if c in FRAUD_DATES else "string") for c in FRAUD_COLUMNS),
    phone_lists,
    read=lambda spark, paths: fraud_rows(read_excel(spark, paths, FRAUD_COLUMNS, FRAUD_DATES)),
)

#: Columns that only some years' login logs have.
LATER_COLUMNS = {"source": "string", "role": "string"}


def with_later_columns(df: DataFrame) -> DataFrame:
    return add_missing(df, LATER_COLUMNS)


def sheet_headings(df: DataFrame) -> DataFrame:
    """Headings of a spreadsheet export in snake case."""
    return rename_all(df, snake)

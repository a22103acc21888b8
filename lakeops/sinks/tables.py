"""Writers for lake tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.text import quoted

KEYS = ("year_key", "month_key", "day_key")


def spread(df: DataFrame, keys: tuple[str, ...], files_per_day: int) -> DataFrame:
    """Rows of one day on at most `files_per_day` tasks, whatever share of the data the day holds."""
    if files_per_day == 1:
        return df.repartition(*keys)
    # salted by content, so that a task run again after a lost executor puts every row in the same place
    salt = F.pmod(F.xxhash64(*[quoted(c) for c in df.columns]), F.lit(files_per_day)).alias("_salt")
    salted = df.select("*", salt)
    return salted.repartition(*keys, "_salt").drop("_salt")


def dealt(df: DataFrame, keys: tuple[str, ...], files_per_day: int | None) -> DataFrame:
    return df.hint("rebalance", *[F.col(k) for k in keys]) if files_per_day is None else spread(df, keys, files_per_day)


def write_days(
    df: DataFrame,
    path: str,
    keys: tuple[str, ...] = KEYS,
    mode: str = "error",
    files_per_day: int | None = None,
    compression: str = "snappy",
    table: str | None = None,
) -> None:
    """Parquet partitioned by `keys`.

    Rows are rebalanced by day as they are written: large days are split over several files of the advisory size and
    small ones are written together, so the number of files follows the data, not tasks times days. `files_per_day`
    fixes the number instead. With `table` the folder is registered in the catalogue too.
    """
    out = dealt(df, keys, files_per_day)
    writer = out.write.mode(mode).partitionBy(*keys).option("compression", compression)
    if table is None:
        writer.parquet(path)
    else:
        writer.format("parquet").option("path", path).saveAsTable(table)


def replace_days(
    df: DataFrame,
    path: str,
    keys: tuple[str, ...] = KEYS,
    files_per_day: int | None = None,
    measures: dict[str, Column] | None = None,
    aside: tuple[str, ...] = (),
) -> dict:
    """Write the days present in `df`, replacing those days only. A day arrives whole or not at all.

    `measures` are aggregates told of the rows as they are written, without another pass over them; the columns `aside`
    are there for them and not written. They are taken behind the last shuffle, where a task that runs again after a lost
    executor doesn't count twice.
    """
    out, seen = dealt(df, keys, files_per_day), Observation()
    if measures:
        out = out.observe(seen, *[c.alias(name) for name, c in measures.items()])
    writer = out.drop(*aside).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*keys).option("compression", "snappy").parquet(path)
    return seen.get if measures else {}


def write_buckets(df: DataFrame, path: str, table: str, keys: tuple[str, ...], buckets: int) -> None:
    """A base table kept in hash buckets of its merge keys: joins on these keys then leave the base where it is and
    shuffle only the slice."""
    writer = df.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def overwrite(df: DataFrame, path: str, compression: str = "snappy") -> None:
    """Replace an unpartitioned table. `df` must not read from `path`: see `replace_self`."""
    df.write.mode("overwrite").option("compression", compression).parquet(path)


def replace_self(spark: SparkSession, df: DataFrame, version_path: str, view: str) -> DataFrame:
    """For a result computed from the table it replaces: write a new version folder, then point `view` at it.

    The old folder stays until the caller removes it, so a failed write loses nothing.
    """
    df.write.mode("error").parquet(version_path)
    new = spark.read.parquet(version_path)
    new.createOrReplaceTempView(view)
    return new


def append_snapshot(df: DataFrame, path: str, keys: tuple[str, ...] = (*KEYS, "hh_mm")) -> None:
    df.write.mode("append").partitionBy(*keys).parquet(path)


def load_warehouse(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Create the table if absent, empty it, load it, keeping its definition and grants."""
    writer = df.write.format("jdbc").mode("overwrite").option("truncate", True)
    writer.option("url", url).option("dbtable", table).options(**options).save()

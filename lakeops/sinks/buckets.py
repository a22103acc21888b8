"""Base tables in buckets of their keys, of which a slice rewrites only those it meets.

    <path>/rows/_bucket=<n>/   the rows whose keys hash to n
    <path>/columns/            a table of no rows, for the columns
    <path>/digests/            a versioned table: per bucket the number of its rows and the sums of two hashes of each

All rows of one key lie in one bucket, so a merge by these keys can be worked out bucket by bucket: buckets without a key
of the slice are neither read nor written. A bucket is replaced as a whole or not at all.

Digests don't depend on the order of rows and take copies into account. Two tables with the same buckets hold the same
rows, in the columns digested, in every bucket whose digests agree, but for a chance of about 2^-100 a bucket; comparing
them then costs no more than reading the buckets that differ. A bucket without a digest counts as different: the digests of
buckets about to be replaced are taken out first and put back when the rows are there, so a merge that breaks off in
between leaves them unknown, never wrong.

The number of buckets is a choice for the table's life; lists of buckets are the only thing the driver holds. Digests are small
(one row a bucket). A hot key makes a large bucket, which is written by several tasks. One writer at a time; a reader that began
before a merge may find files of the buckets met gone (tables that must be read meanwhile: `versions`).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from lakeops.functions.text import quoted
from lakeops.operators.history import classify_changes
from lakeops.operators.rows import join_on
from lakeops.session import path_exists
from lakeops.sinks.tables import dealt, replace_days
from lakeops.sinks.versions import publish, read_version, vacuum

BUCKET = "_bucket"


def _hash(columns: Sequence[str], seed: int) -> Column:
    """Of the values and of which are NULL, as hashing passes over NULL."""
    cells = [quoted(c) for c in columns]
    return F.xxhash64(F.lit(seed), *cells, *[c.isNull() for c in cells])


@dataclass(frozen=True)
class BucketTable:
    """Rows in `buckets` buckets by the hash of `keys`; digests are of `digested`, by default of all columns."""

    path: str
    keys: tuple[str, ...]
    buckets: int
    digested: tuple[str, ...] | None = None

    def bucket(self) -> Column:
        return F.pmod(_hash(self.keys, 0), F.lit(self.buckets)).cast("int")

    def create(self, df: DataFrame) -> None:
        """Write the whole table and its digests, in place of what is there."""
        self._forget(df.sparkSession, None)
        df.where(F.lit(False)).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/columns")
        self._placed(df).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/rows")
        self._learn(df.sparkSession, None)

    def read(self, spark: SparkSession, only: Sequence[int] | None = None) -> DataFrame:
        """The table, or the buckets `only`: other folders are not opened."""
        return self._rows(spark, only).drop(BUCKET)

    def met(self, day_slice: DataFrame) -> list[int]:
        """The buckets with a key of the slice."""
        return sorted(r[0] for r in day_slice.select(self.bucket()).distinct().collect())

    def merge(self, day_slice: DataFrame, how: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """Replace the buckets that the slice meets by `how(their rows, slice)`; returns which.

        `how` must treat rows by the table's keys, as `upsert_day`, `delete_insert_range` or `delete_matching` do with keys that
        contain these. Rows and slice may be empty; the result has the table's columns and no keys of other buckets.
        """
        spark = day_slice.sparkSession
        met = self.met(day_slice)
        if met:
            self._forget(spark, met)
            # the rows are read and replaced by one job: tasks write beside the table, folders are swapped when all are done
            new = how(self.read(spark, met), day_slice).select(self.read(spark).columns).withColumn(BUCKET, self.bucket())
            told = replace_days(new, f"{self.path}/rows", (BUCKET,), measures={"written": F.collect_set(BUCKET)})
            # a bucket without rows in the result has no folder to be swapped for
            _drop(spark, self, set(met) - set(told.get("written") or ()))
            self._learn(spark, met)
        return met

    def digests(self, spark: SparkSession) -> DataFrame | None:
        """Per bucket with rows and a known digest: `_bucket`, `n_rows`, `first`, `second`. None if there are none yet."""
        return read_version(spark, f"{self.path}/digests") if path_exists(spark, f"{self.path}/digests/manifests") else None

    def _rows(self, spark: SparkSession, only: Sequence[int] | None) -> DataFrame:
        columns = spark.read.parquet(f"{self.path}/columns").schema
        rows = spark.read.schema(columns.add(BUCKET, IntegerType())).parquet(f"{self.path}/rows")
        return rows if only is None else rows.where(F.col(BUCKET).isin([int(b) for b in only]))

    def _placed(self, df: DataFrame) -> DataFrame:
        return dealt(df.withColumn(BUCKET, self.bucket()), (BUCKET,), None)

    def _forget(self, spark: SparkSession, only: list[int] | None) -> None:
        known = self.digests(spark)
        if known is not None:
            publish(known.where(F.lit(False) if only is None else ~F.col(BUCKET).isin(only)).coalesce(1), f"{self.path}/digests")

    def _learn(self, spark: SparkSession, only: list[int] | None) -> None:
        rows = self._rows(spark, only)
        columns = self.digested or tuple(c for c in rows.columns if c != BUCKET)
        total = lambda seed: F.sum(_hash(columns, seed).cast("decimal(20,0)"))
        new = rows.groupBy(BUCKET).agg(F.count("*").alias("n_rows"), total(1).alias("first"), total(2).alias("second"))
        known = self.digests(spark)
        if known is not None:
            new = known.unionByName(new)
        publish(new.coalesce(1), f"{self.path}/digests")
        vacuum(spark, f"{self.path}/digests")


def differing(spark: SparkSession, a: BucketTable, b: BucketTable) -> list[int]:
    """The buckets whose rows may differ between the two tables."""
    if (a.keys, a.buckets, a.digested) != (b.keys, b.buckets, b.digested):
        raise ValueError("tables of different buckets or digests can't be compared")
    mine, other = a.digests(spark), b.digests(spark)
    if mine is None or other is None:
        return list(range(a.buckets))
    # a bucket that neither table tells of is either empty in both or unknown: its folder tells which
    columns = [BUCKET, "n_rows", "first", "second"]
    equal = {r[0] for r in join_on(mine, other, columns, "left_semi", True).select(BUCKET).collect()}
    return sorted(n for n in _folders(spark, a) | _folders(spark, b) if n not in equal)


def _folders(spark: SparkSession, t: BucketTable) -> set[int]:
    """The buckets with a folder, from the listing alone."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{t.path}/rows")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    names = [s.getPath().getName().split("=") for s in found]
    return {int(name[1]) for name in names if name[0] == BUCKET}


def _drop(spark: SparkSession, t: BucketTable, buckets: set[int]) -> None:
    for n in sorted(buckets):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{t.path}/rows/{BUCKET}={n}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def change_classes(
    spark: SparkSession, current: BucketTable, incoming: BucketTable, id_column: str, rowhash: str = "rowhash", unchanged: bool = True
) -> DataFrame:
    """`classify_changes` of the two tables, both in buckets of the id with digests of id and hash.

    Only buckets that differ are compared. In the others every id is N and every incoming row without id is I, as the
    current rows are the incoming ones: these buckets are read on the incoming side only. With `unchanged=False` they are not
    read at all, and only I, D and U of the buckets that differ come out.
    """
    for t in (current, incoming):
        if t.keys != (id_column,) or set(t.digested or ()) != {id_column, rowhash}:
            raise ValueError("tables must be in buckets of the id with digests of id and hash")
    changed = differing(spark, current, incoming)
    told = classify_changes(current.read(spark, changed), incoming.read(spark, changed), id_column, rowhash)
    if not unchanged:
        return told.where("iud_op != 'N'")
    same = sorted(_folders(spark, incoming) - set(changed))
    rows = incoming.read(spark, same)
    return told.unionByName(classify_changes(rows, rows, id_column, rowhash)) if same else told

"""Tables by versions."""

import pytest
from lakeops.sinks.versions import VersionConflict, publish, read_version, vacuum, versions
from pyspark.sql import functions as F


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_a_table_replaces_itself_for_all_sessions(spark, tmp_path):
    path = f"file:{tmp_path}/t"
    assert publish(spark.range(6), path) == 1
    pinned = read_version(spark, path)
    assert publish(read_version(spark, path).where("id > 2"), path) == 2
    assert ids(read_version(spark.newSession(), path)) == [3, 4, 5]
    assert ids(pinned) == ids(read_version(spark, path, 1)) == list(range(6))
    with pytest.raises(FileNotFoundError):
        read_version(spark, path, 3)
    with pytest.raises(FileNotFoundError):
        read_version(spark, f"{tmp_path}/none")


def test_a_write_that_breaks_off_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(spark.range(3), path)
    broken = spark.range(100).select(F.when(F.col("id") == 70, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        publish(broken, path)
    assert versions(spark, path) == [1] and ids(read_version(spark, path)) == [0, 1, 2]
    assert publish(spark.range(1), path) == 2


def test_the_second_of_two_writers_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    assert publish(spark.range(1), path, after=0) == 1
    assert publish(spark.range(2), path, after=1) == 2
    with pytest.raises(VersionConflict):
        publish(spark.range(3), path, after=1)
    assert versions(spark, path) == [1, 2] and ids(read_version(spark, path)) == [0, 1]
    assert [x.name for x in (tmp_path / "t" / "manifests").iterdir() if x.name.endswith(".part")] == []


def test_vacuum_keeps_the_live_version(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (1, 2, 3):
        publish(spark.range(n), path)
    spark.range(9).write.parquet(f"{path}/data/000000000009-brokenoff")
    assert vacuum(spark, path) == [] and versions(spark, path) == [1, 2, 3]
    gone = vacuum(spark, path, keep=1, idle=-1)
    assert len(gone) == 3 and "000000000009-brokenoff" in gone
    assert versions(spark, path) == [3] and ids(read_version(spark, path)) == [0, 1, 2]
    assert publish(spark.range(0), path) == 4 and ids(read_version(spark, path)) == []
    with pytest.raises(ValueError):
        vacuum(spark, path, keep=0)

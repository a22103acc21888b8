"""Unpartitioned tables replaced as a whole, by versions that readers in any session see.

    <path>/data/<number>-<id>/   one folder per version
    <path>/manifests/<number>    names the folder of that version; the greatest number is live

A version is written beside the others first and becomes live when its manifest is renamed into place, which takes no
other manifest's place: of two writers that set out from one version the second fails. A write that breaks off leaves
the live version as it is. Readers hold the folder they were given, so a table may be computed from the one it replaces, and a
query that runs during a replacement reads one version. `vacuum` removes old ones.

Where renaming is no single step (plain object stores), a lost race between two writers may go unnoticed; one writer is safe.
"""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

WEEK = 7 * 24 * 3600


class VersionConflict(RuntimeError):
    """Another writer has published the version that this one wanted to."""


class _Folder:
    """The table's folder by Hadoop's own file access, so it may lie wherever Spark's tables may."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.hadoop.Path(path).getFileSystem(self.conf)

    def at(self, *names: str):
        return self.hadoop.Path("/".join([self.path, *names]))

    def names(self, folder: str) -> dict[str, float]:
        """What lies in a folder, and when it was last changed, in seconds."""
        if not self.fs.exists(self.at(folder)):
            return {}
        return {s.getPath().getName(): s.getModificationTime() / 1000 for s in self.fs.listStatus(self.at(folder))}

    def versions(self) -> list[int]:
        return sorted(int(name) for name in self.names("manifests") if name.isdigit())

    def data(self, version: int) -> str:
        stream = self.fs.open(self.at("manifests", f"{version:012d}"))
        try:
            return stream.readUTF()
        finally:
            stream.close()

    def publish(self, version: int, data: str) -> None:
        part, whole = self.at("manifests", f"{uuid.uuid4().hex}.part"), self.at("manifests", f"{version:012d}")
        stream = self.fs.create(part, False)
        stream.writeUTF(data)
        stream.close()
        rename = getattr(self.hadoop, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.NONE
        try:
            self.hadoop.FileContext.getFileContext(self.fs.getUri(), self.conf).rename(part, whole, how)
        except Py4JJavaError as e:
            if self.fs.exists(whole):
                self.fs.delete(part, False)
                raise VersionConflict(f"{self.path} has a version {version} already") from e
            raise


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that can be read, the live one last."""
    return _Folder(spark, path).versions()


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The live version, or the one named. The frame stays with it, whatever is published later."""
    folder = _Folder(spark, path)
    found = folder.versions()
    if not found or version not in (None, *found):
        raise FileNotFoundError(f"{path} has no version{'' if version is None else f' {version}'}")
    return spark.read.parquet(f"{folder.path}/data/{folder.data(found[-1] if version is None else version)}")


def publish(df: DataFrame, path: str, compression: str = "snappy", after: int | None = None) -> int:
    """Write `df` as the next version and make it live; its number. `df` may read the table itself.

    `after` is the version that `df` was computed from (0: none), by default the live one when this is called. If another writer
    has published since then, this fails with `VersionConflict` and changes nothing.
    """
    folder = _Folder(df.sparkSession, path)
    base = (folder.versions() or [0])[-1] if after is None else after
    data = f"{base + 1:012d}-{uuid.uuid4().hex}"
    df.write.mode("error").option("compression", compression).parquet(f"{folder.path}/data/{data}")
    folder.publish(base + 1, data)
    return base + 1


def vacuum(spark: SparkSession, path: str, keep: int = 2, idle: float = WEEK) -> list[str]:
    """Remove all versions but the last `keep`, and folders of writes that broke off; the names of the data folders removed.

    What was changed within the last `idle` seconds stays: a reader may still hold it, or a writer may be at work on it.
    """
    if keep < 1:
        raise ValueError("the live version stays")
    folder, old = _Folder(spark, path), time.time() - idle
    manifests, found = folder.names("manifests"), folder.versions()
    last = [v for k, v in enumerate(found) if k >= len(found) - keep or manifests[f"{v:012d}"] > old]
    kept = {folder.data(v) for v in last}
    for v in found:
        if v not in last:
            folder.fs.delete(folder.at("manifests", f"{v:012d}"), False)
    gone = sorted(name for name, changed in folder.names("data").items() if name not in kept and changed <= old)
    for name in gone:
        folder.fs.delete(folder.at("data", name), True)
    return gone

"""Line dedup over all documents: a line stays only in the least document that holds it.

The hashes of all lines are range-partitioned and sorted by (hash, document, position), so each task streams through runs
of equal lines and needs to remember one document only: the first of the run. A line found in a third of all documents
is split over several ranges by the document; a run that began in an earlier range is settled by one small row per
range. What comes back is not text but, per document that loses lines, a compressed bitmap of the lines it keeps.

Edge cases: NULL or empty text is one empty line, which is too short to be compared. Repetitions within one document stay
if that document is the least that holds the line. Rows with one key and different texts are told apart by a hash of the
text; rows equal in both are judged alike. NULL keys come first and count as one document. Lines are compared by 128 bits.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from lakeops.llm.ranges import known_key
from lakeops.llm.words import GAP_CHARS
from lakeops.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(GAP_CHARS)), UPPER, LOWER)


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_hashes(documents: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """One row per line long enough to be compared: key, doc, text_hash, pos."""
    lines = documents.select(known_key(F.col(id_col)).alias("doc"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"), F.posexplode(text_lines(F.col(text_col))).alias("pos", "line"))
    lines = lines.withColumn("line", line_key(F.col("line"))).where(F.length("line") >= min_chars)
    return lines.select(F.unhex(F.md5("line")).alias("key"), "doc", "text_hash", "pos")


FOUND = "kind string, range int, key binary, doc bigint, text_hash bigint, pos int, last_key binary, last_doc bigint"


def stream_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines after the first document of their run, in sorted input.

    `drop`: to go. `open`: equal to the first line of this range, so an earlier range may hold its first document. One
    `range` row tells the first line and its document, and the last line and the first document of its run.
    """
    part, first, last = TaskContext.get().partitionId(), None, None
    for b in batches:
        if not len(b):
            continue
        keys, docs = b["key"].to_numpy(), b["doc"].to_numpy(np.int64)
        starts = np.ones(len(b), bool)
        starts[1:] = keys[1:] != keys[:-1]
        starts[0] = last is None or keys[0] != last[0]
        at = np.flatnonzero(starts)
        first_of_run = np.concatenate([[last[1] if last else docs[0]], docs[at]])[np.cumsum(starts)]
        first = first or (keys[0], docs[0])
        last = (keys[-1], first_of_run[-1])
        is_open = keys == first[0]
        for kind, mask in (("drop", (docs != first_of_run) & ~is_open), ("open", is_open)):
            if mask.any():
                yield pd.DataFrame({"kind": kind, "range": part, "key": None, "doc": docs[mask], "text_hash": b["text_hash"][mask], "pos": b["pos"][mask], "last_key": None, "last_doc": None})
    if first is not None:
        yield pd.DataFrame({"kind": ["range"], "range": [part], "key": [first[0]], "doc": [first[1]], "text_hash": [None], "pos": [None], "last_key": [last[0]], "last_doc": [last[1]]})


def first_documents(ranges: list) -> dict[int, object]:
    """For each range, the first document that holds the range's first line, wherever the run began."""
    out, before = {}, None
    for r in sorted(ranges, key=lambda r: r["range"]):
        begun = before is not None and before[0] == r["key"]
        out[r["range"]] = before[1] if begun else r["doc"]
        whole = r["last_key"] == r["key"]
        before = (r["last_key"], out[r["range"]] if whole else r["last_doc"])
    return out


def duplicate_lines(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """(doc, text_hash, pos) of every line to drop."""
    lines = line_hashes(documents, id_col, text_col, min_chars).repartitionByRange("key", "doc", "text_hash", "pos").sortWithinPartitions("key", "doc", "text_hash", "pos")
    found = materialize(lines.mapInPandas(stream_runs, FOUND), "line-runs")
    firsts = first_documents(found.where("kind = 'range'").select("range", "key", "doc", "last_key", "last_doc").collect())
    first = found.sparkSession.createDataFrame([(k, int(v)) for k, v in firsts.items()], "range int, first_doc bigint")
    settled = found.where("kind = 'open'").join(first, "range").where("doc != first_doc")
    return found.where("kind = 'drop'").select("doc", "text_hash", "pos").unionByName(settled.select("doc", "text_hash", "pos"))


@F.pandas_udf(BinaryType())
def pack(dropped: pd.Series) -> pd.Series:
    """Compressed bitmap, 1 for a kept line; lines behind its end are kept."""

    def one(positions) -> bytes:
        bits = np.ones(max(positions) // 8 * 8 + 8, np.uint8)
        bits[np.asarray(positions)] = 0
        return zlib.compress(np.packbits(bits).tobytes())

    return dropped.map(one)


def keep_bitmaps(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """(doc, text_hash, n_dropped, keeps): one row per document that loses lines. Rows equal in key and text share one."""
    gone = duplicate_lines(documents, id_col, text_col, min_chars).groupBy("doc", "text_hash").agg(F.collect_set("pos").alias("gone"))
    return gone.select("doc", "text_hash", F.size("gone").cast("long").alias("n_dropped"), pack("gone").alias("keeps"))


def kept_text(text: str, keeps: bytes) -> str:
    lines = text.split("\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keeps), np.uint8))[: len(lines)]
    return "\n".join([x for x, k in zip(lines, bits, strict=False) if k] + lines[len(bits) :])


@F.pandas_udf(StringType())
def apply_bitmap(text: pd.Series, keeps: pd.Series) -> pd.Series:
    return pd.Series([None if k is None else kept_text(t or "", k) for t, k in zip(text, keeps, strict=True)], dtype=object)


@F.pandas_udf(StringType())
def kept_hash(text: pd.Series, keeps: pd.Series) -> pd.Series:
    return pd.Series([None if k is None else hashlib.sha256(kept_text(t or "", k).encode()).hexdigest() for t, k in zip(text, keeps, strict=True)], dtype=object)


def with_bitmaps(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, prefix: str = "_") -> DataFrame:
    """`documents` with `<prefix>n_dropped` and `<prefix>keeps`, NULL where no line goes. No column of theirs may begin with the prefix."""
    own = {"doc": "doc", "hash": "text_hash", "n_dropped": "n_dropped", "keeps": "keeps"}
    maps = keep_bitmaps(documents, id_col, text_col, min_chars).select(*[F.col(c).alias(f"{prefix}{name}") for name, c in own.items()])
    docs = documents.withColumn(f"{prefix}text_hash", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    same = (known_key(docs[id_col]) == F.col(f"{prefix}doc")) & (F.col(f"{prefix}text_hash") == F.col(f"{prefix}hash"))
    return docs.join(maps, same, "left").drop(*(f"{prefix}{c}" for c in ("doc", "hash", "text_hash")))


def deduped_documents(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """The documents with their kept lines only, with their own columns; a text that loses no line is as it was. Their
    other columns may have any names."""
    prefix = "_line_"
    while any(c.lower().startswith(prefix) for c in documents.columns):
        prefix += "_"
    joined = with_bitmaps(documents, id_col, text_col, min_chars, prefix)
    keeps = F.col(f"{prefix}keeps")
    changed = apply_bitmap(F.when(keeps.isNotNull(), F.col(text_col)), keeps)
    return joined.withColumn(text_col, F.coalesce(changed, F.col(text_col))).select(*documents.columns)

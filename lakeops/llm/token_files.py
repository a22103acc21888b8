"""Token-id files: one compressed frame per document, a dictionary shared by all, and an index of offsets.

A token file is a folder of three tables, written and read by Spark only, so it can lie in any store:

- `dictionary`: one row, the zstandard dictionary trained on serialized id arrays of a bounded sample of short documents
  (`sample_documents` of them, the least by hash of their id, none longer than `sample_chars`), and its sha256;
- `blocks`: up to `block_bytes` of frames in one binary cell, with the documents' ids, their numbers of tokens, the offset
  of each frame, and the sha256 of the dictionary they need; blocks are in ascending order of the id;
- `index`: per block, the first and last id and the number of tokens in all blocks before it.

So one short document is found by the index, its block is read, and its frame alone is decompressed.

Edge cases: NULL and empty texts have the end id only. NULL ids come first. Documents that share an id are ordered by
their ids' frame. An empty table gives an empty file. With too few samples to train on, the frames stand without dictionary.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeops.llm.byte_bpe import encoder
from lakeops.llm.ranges import LEAST, known_key, range_bounds, range_of, real_key

WIDE = np.dtype("<u4")
NARROW = np.dtype("<u2")


def serialize(ids: np.ndarray) -> bytes:
    """A byte telling the width, then the ids: two bytes each if all fit, else four."""
    narrow = not len(ids) or int(ids.max()) < 1 << 16
    return bytes([2 if narrow else 4]) + ids.astype(NARROW if narrow else WIDE).tobytes()


def deserialize(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, NARROW if raw[0] == 2 else WIDE, offset=1).astype(WIDE)


def compressor(dictionary: bytes, level: int) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None, write_dict_id=False)


def decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


BATCH_CHARS = 2_000_000


def token_ids(texts: list[str | None], vocabulary: str, end_id: int) -> Iterator[np.ndarray]:
    """The ids of each text with the end id, some million characters at a time."""
    texts = [t or "" for t in texts]
    part = np.cumsum([len(t) for t in texts]) // BATCH_CHARS
    edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(texts) else []
    for s, e in zip(edges[:-1], edges[1:], strict=True):
        ids, counts = encoder(vocabulary).encode_all(texts[s:e])
        ends = np.cumsum(counts)
        for n, end in zip(counts, ends, strict=True):
            yield np.append(ids[end - n : end], np.uint32(end_id))


def training_texts(documents: DataFrame, sample_documents: int, sample_chars: int) -> DataFrame:
    """The texts to train on, one per chosen id, the least by hash."""
    short = documents.where(F.length("text").between(1, sample_chars))
    chosen = short.select("doc_id").where(F.col("doc_id") != LEAST).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_documents)
    texts = short.join(F.broadcast(chosen), "doc_id").select("doc_id", "text")
    return texts.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text")).select("text")


def train_dictionary(documents: DataFrame, vocabulary: str, end_id: int, sample_documents: int, sample_chars: int, dictionary_bytes: int) -> bytes:
    """Trained in one task on a sample bounded by `sample_documents` times `sample_chars`."""
    sample = training_texts(documents, sample_documents, sample_chars).coalesce(1)

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        samples = [serialize(ids) for b in batches for ids in token_ids(b["text"].tolist(), vocabulary, end_id)]
        try:
            made = zstandard.train_dictionary(dictionary_bytes, samples).as_bytes() if len(samples) >= 16 else b""
        except zstandard.ZstdError:
            made = b""
        yield pd.DataFrame({"dictionary": [made]})

    row = sample.mapInPandas(train, "dictionary binary").first()
    return bytes(row["dictionary"]) if row else b""


def write(documents: DataFrame, path: str, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", sample_documents: int = 2000, sample_chars: int = 20_000, dictionary_bytes: int = 65_536, block_bytes: int = 2 << 20, level: int = 3) -> None:
    """Tokens of all documents, in ascending order of the id, as a token file below `path`."""
    spark = documents.sparkSession
    docs = documents.select(known_key(F.col(id_col)).alias("doc_id"), F.col(text_col).alias("text"))
    dictionary = train_dictionary(docs, vocabulary, end_id, sample_documents, sample_chars, dictionary_bytes)
    sha = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(sha, bytearray(dictionary), end_id)], "sha256 string, dictionary binary, end_id long").coalesce(1).write.parquet(f"{path}/dictionary")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = range_bounds(docs, "doc_id", n)

    def frames(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = compressor(dictionary, level)
        for b in batches:
            counts, made = [], []
            for ids in token_ids(b["text"].tolist(), vocabulary, end_id):
                counts.append(len(ids))
                made.append(packer.compress(serialize(ids)))
            yield pd.DataFrame({"range": range_of(b["doc_id"], bounds), "doc_id": b["doc_id"], "n_tokens": counts, "frame": made})

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list = []

        def block() -> pd.DataFrame:
            sizes = [len(f) for _, _, _, f in held]
            one = {"range": held[0][0], "block": number, "doc_ids": [h[1] for h in held], "n_tokens": [h[2] for h in held], "offsets": np.cumsum([0, *sizes]), "frames": b"".join(h[3] for h in held), "dictionary_sha256": sha}
            return pd.DataFrame({k: [v] for k, v in one.items()})

        number = 0
        for b in batches:
            for row in zip(b["range"], b["doc_id"], b["n_tokens"], b["frame"], strict=True):
                if held and (row[0] != held[0][0] or sum_bytes > block_bytes):
                    yield block()
                    number, held = number + 1, []
                if not held:
                    sum_bytes = 0
                held.append(row)
                sum_bytes += len(row[3]) + 16
        if held:
            yield block()

    ordered = docs.mapInPandas(frames, "range int, doc_id bigint, n_tokens bigint, frame binary")
    ordered = ordered.repartitionById(n, F.col("range")).sortWithinPartitions("range", "doc_id", "n_tokens", "frame")
    shape = "range int, block int, doc_ids array<bigint>, n_tokens array<bigint>, offsets array<bigint>, frames binary, dictionary_sha256 string"
    ordered.mapInPandas(blocks, shape).write.option("compression", "none").parquet(f"{path}/blocks")

    made = spark.read.parquet(f"{path}/blocks").select("range", "block", F.get("doc_ids", F.lit(0)).alias("first_id"), F.get("doc_ids", F.size("doc_ids") - 1).alias("last_id"), F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("tokens"))
    totals = made.groupBy("range").agg(F.sum("tokens").alias("all"))
    earlier = totals.select("range", F.coalesce(F.sum("all").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))
    inside = F.coalesce(F.sum("tokens").over(W.partitionBy("range").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    index = made.withColumn("inside", inside).join(earlier, "range").select("range", "block", "first_id", "last_id", "tokens", (F.col("earlier") + F.col("inside")).alias("start"))
    index.write.parquet(f"{path}/index")


def read(spark: SparkSession, path: str, only_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian 32-bit) of all documents of a token file, or of some few.

    For a few documents the index tells the blocks; only their frames are decompressed.
    """
    head = spark.read.parquet(f"{path}/dictionary").first()
    dictionary, sha = bytes(head["dictionary"]), head["sha256"]
    if hashlib.sha256(dictionary).hexdigest() != sha:
        raise ValueError(f"the dictionary of {path} is damaged")
    index = spark.read.parquet(f"{path}/index")
    if only_ids is not None:
        wanted = F.lit(False)
        for i in only_ids:
            wanted = wanted | F.lit(i).between(F.col("first_id"), F.col("last_id"))
        index = index.where(wanted)
    chosen = spark.read.parquet(f"{path}/blocks").join(index.select("range", "block", "start"), ["range", "block"])
    wanted_ids = None if only_ids is None else set(only_ids)

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = decompressor(dictionary)
        for b in batches:
            for r in b.itertuples(index=False):
                if r.dictionary_sha256 != sha:
                    raise ValueError("the block was made with another dictionary")
                start, out = int(r.start), []
                for k, (i, n) in enumerate(zip(r.doc_ids, r.n_tokens, strict=True)):
                    if wanted_ids is None or i in wanted_ids:
                        ids = deserialize(reader.decompress(r.frames[r.offsets[k] : r.offsets[k + 1]]))
                        out.append((int(i), start, int(n), ids.tobytes()))
                    start += int(n)
                yield pd.DataFrame(out, columns=["doc_id", "start", "n_tokens", "ids"])

    rows = chosen.mapInPandas(unpack, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
    return rows.withColumn("doc_id", real_key(F.col("doc_id")))

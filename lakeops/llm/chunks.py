"""Documents in chunks, and questions about hashes that chunks put to buckets.

Several operators ask of every window of every text whether it occurs elsewhere. As rows, the windows of a corpus are many
times its size. So documents are written once to the scratch folder as chunks of a few megabytes, and each chunk asks:
it sorts its distinct window hashes, cuts them into buckets by their leading bits and sends each bucket one cell of
compressed differences, about three bytes a window. A bucket is a Spark group: it sees that slice of all chunks' hashes,
so it knows what occurs where, and returns one cell of bits per chunk, in the order asked.

A hash that a third of all documents share costs one entry per chunk, as chunks send distinct hashes; a bucket holds about
`BUCKET_BYTES` of text's worth of hashes, whatever the size of the corpus. Chunks and answers are tables and shuffles of
Spark's, so a lost executor costs a repetition of its tasks only.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.ranges import known_key
from lakeops.session import materialize

CHUNK_BYTES = 6 << 20
BUCKET_BYTES = 12 << 20
ANSWERS = "chunk bigint, bucket int, cell binary"


class Chunk:
    """Ids of some documents and their texts as bytes; document k is `data[starts[k]:starts[k + 1]]`."""

    def __init__(self, body: bytes):
        ids, sizes, data = pickle.loads(zstandard.ZstdDecompressor().decompress(body))
        self.ids = np.frombuffer(ids, np.int64)
        self.starts = np.concatenate([[0], np.cumsum(np.frombuffer(sizes, np.int64))])
        self.data = data

    def texts(self) -> Iterator[bytes]:
        for s, e in zip(self.starts[:-1], self.starts[1:], strict=True):
            yield self.data[s:e]


def texts_body(ids: np.ndarray, texts: list[bytes]) -> tuple:
    """What `Chunk` reads: ids, sizes and the texts themselves."""
    return ids.tobytes(), np.array([len(t) for t in texts], np.int64).tobytes(), b"".join(texts)


def chunk_table(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    body_of: Callable[[np.ndarray, list[bytes]], tuple] = texts_body,
) -> DataFrame:
    """(chunk, n_bytes, body), written to the scratch folder. A document is in one chunk, however long it is.

    `body_of` says what is kept of a chunk's ids and texts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, number = zstandard.ZstdCompressor(level=1), TaskContext.get().partitionId() << 32
        ids: list[int] = []
        texts: list[bytes] = []
        held = 0

        def chunk() -> pa.RecordBatch:
            body = packer.compress(pickle.dumps(body_of(np.array(ids, np.int64), texts), 5))
            return pa.RecordBatch.from_pydict({"chunk": pa.array([number], pa.int64()), "n_bytes": pa.array([held], pa.int64()), "body": pa.array([body], pa.binary())})

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), pc.fill_null(b.column(1), "").cast(pa.binary()).to_pylist(), strict=True):
                ids.append(i)
                texts.append(t)
                held += len(t) + 8
                if held >= chunk_bytes:
                    yield chunk()
                    ids, texts, held, number = [], [], 0, number + 1
        if ids:
            yield chunk()

    docs = documents.select(known_key(F.col(id_col)).alias("id"), F.col(text_col).alias("text"))
    return materialize(docs.mapInArrow(rows, "chunk bigint, n_bytes bigint, body binary"), "chunks")


def bucket_count(chunks: DataFrame) -> int:
    """Buckets in proportion to the bytes of text."""
    return int((chunks.agg(F.sum("n_bytes")).first()[0] or 0) // BUCKET_BYTES) + 1


def buckets_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted 64-bit hashes; one entry more than buckets."""
    edges = [(k << 64) // buckets for k in range(1, buckets)]
    return np.concatenate([[0], np.searchsorted(hashes, np.array(edges, np.uint64)), [len(hashes)]])


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes of equal weight side by side, compressed; bool arrays as bits."""
    packer = zstandard.ZstdCompressor(level=1)
    out = []
    for a in arrays:
        raw = np.packbits(a) if a.dtype == bool else np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T)
        out.append((a.dtype.str, len(a), packer.compress(raw.tobytes())))
    return pickle.dumps(out, 5)


def unpack(cell: bytes) -> list[np.ndarray]:
    reader, out = zstandard.ZstdDecompressor(), []
    for kind, n, raw in pickle.loads(cell):
        flat = np.frombuffer(reader.decompress(raw), np.uint8)
        if np.dtype(kind) == bool:
            out.append(np.unpackbits(flat)[:n].astype(bool))
        else:
            out.append(np.ascontiguousarray(flat.reshape(np.dtype(kind).itemsize, n).T).reshape(-1).view(kind) if n else np.empty(0, kind))
    return out


def differences(hashes: np.ndarray) -> np.ndarray:
    return np.diff(hashes, prepend=np.uint64(0))


def sums(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=np.uint64)


def questions(chunk: int, hashes: np.ndarray, more: tuple[np.ndarray, ...], buckets: int) -> pd.DataFrame:
    """One row per bucket: the sorted distinct `hashes` that fall into it, and what else is told of each."""
    at = buckets_of(hashes, buckets)
    rows = [(k, chunk, pack(differences(hashes[s:e]), *[m[s:e] for m in more])) for k, (s, e) in enumerate(zip(at[:-1], at[1:], strict=True)) if e > s]
    return pd.DataFrame(rows, columns=["bucket", "chunk", "cell"])


def ask(chunks: DataFrame, question: Callable[[int, Chunk], pd.DataFrame], read: type = Chunk, schema: str = "bucket int, chunk bigint, cell binary") -> DataFrame:
    """(bucket, chunk, cell): what `question` asks for each chunk, as `read` makes it of its body."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for number, body in zip(b["chunk"], b["body"], strict=True):
                yield question(int(number), read(body))

    return chunks.select("chunk", "body").mapInPandas(rows, schema)


class Asked:
    """All chunks' questions to one bucket, brought together by hash.

    `hashes` are the distinct ones, `which` gives for each entry asked its place among them, entries in order of the chunks.
    """

    def __init__(self, group: pd.DataFrame):
        group = group.sort_values("chunk")
        self.bucket, self.chunks = int(group["bucket"].iloc[0]), group["chunk"].to_numpy()
        cells = [unpack(c) for c in group["cell"]]
        self.sizes = np.array([len(c[0]) for c in cells])
        entries = np.concatenate([sums(c[0]) for c in cells])
        self.more = [np.concatenate([c[k] for c in cells]) for k in range(1, len(cells[0]))]
        order = np.argsort(entries, kind="stable")
        ordered = entries[order]
        starts = np.ones(len(ordered), bool)
        starts[1:] = ordered[1:] != ordered[:-1]
        self.order, self.at = order, np.flatnonzero(starts)
        self.hashes = ordered[self.at]
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(starts) - 1
        self.asking = np.diff(np.append(self.at, len(order)))

    def gather(self, ufunc: np.ufunc, values: np.ndarray) -> np.ndarray:
        """For each distinct hash, `ufunc` over the values of its entries."""
        return ufunc.reduceat(values[self.order], self.at)

    def answers(self, *per_entry: np.ndarray) -> pd.DataFrame:
        ends = np.cumsum(self.sizes)
        rows = [(int(c), self.bucket, pack(*[a[e - n : e] for a in per_entry])) for c, n, e in zip(self.chunks, self.sizes, ends, strict=True)]
        return pd.DataFrame(rows, columns=["chunk", "bucket", "cell"])


def answer(asked: DataFrame, answers: Callable[[Asked], pd.DataFrame]) -> DataFrame:
    """(chunk, bucket, cell): the answers of all buckets."""
    return asked.groupBy("bucket").applyInPandas(lambda group: answers(Asked(group)), ANSWERS)


def answered(cells: pd.DataFrame) -> list[np.ndarray]:
    """A chunk's answers from all buckets, in the order of its sorted hashes; an empty list if it asked nothing."""
    parts = [unpack(c) for c in cells.sort_values("bucket")["cell"]]
    return [np.concatenate([p[k] for p in parts]) for k in range(len(parts[0]))] if parts else []


def settle(
    chunks: DataFrame, answers: DataFrame, rows: Callable[[int, Chunk, pd.DataFrame], pd.DataFrame], schema: str, read: type = Chunk, tasks: int | None = None
) -> DataFrame:
    """`rows` of every chunk with its answers: (chunk number, chunk, cells) -> rows of `schema`; in as many `tasks`, if a number is given."""

    def one(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return rows(int(left["chunk"].iloc[0]), read(left["body"].iloc[0]), right)

    chunks = chunks.select("chunk", "body")
    if tasks:
        chunks, answers = chunks.repartition(tasks, "chunk"), answers.repartition(tasks, "chunk")
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(one, schema)

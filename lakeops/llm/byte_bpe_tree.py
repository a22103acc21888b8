"""Byte-level BPE by monoid tree reduction: halves are encoded on their own, neighbours are joined at their boundary.

A text is cut in the middle, again and again, down to leaves. To join two neighbours, only a window around the boundary is
encoded again, and it grows until what lies outside can't change:

- Between a character that is no white space and a space, or between a letter and an ASCII character that is none, the
  vocabulary's pattern always ends a match, whatever else stands around. The window grows by doubling to the nearest such
  place on either side. Tokens beyond it stay; how many of them the window replaces is told by their lengths in bytes.
- Inside a run of letters without such a place the window grows by tokens. A sequence of tokens is the encoding of a
  match exactly if each two neighbours are the encoding of their own bytes, so the join is done once both rims of the
  window agree with the tokens outside.

Decoding concatenates the bytes of tokens up the same kind of tree.

Edge cases: NULL and empty texts have no ids and decode to nothing. Repeated rows give equal results. A very long text is one
row of one task, in memory of a few times its length; batches are cut by bytes. Empty tables give empty results. Columns
other than the two named are not read, so their names don't matter. Special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAF = 4096
FIRST_WINDOW = 16
#: Letters on either side that a window inside a run may grow over; beyond, the whole run is encoded again.
RUN_WINDOW = 128
BATCH_BYTES = 8_000_000
#: Letters by every edition of Unicode.
LETTERS = "A-Za-zÀ-ÖØ-öø-ſΑ-ΡА-яぁ-ゖ一-龥가-힣"
#: Places where the pattern ends a match in any surroundings.
CUT = re.compile(rf"(?<=[^\s\x1c-\x1f\x85᠎])(?=[ \n])|(?<=[{LETTERS}])(?=[\x00-@\[-`{{-\x7f])")
LETTER_RUN = re.compile(f"[{LETTERS}]+")


class Codec:
    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})
        self.raw = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.raw[rank] = token
        self.sizes = np.array([len(t) for t in self.raw], np.int64)
        self.stable: dict[tuple[int, int], bool] = {}

    def leaf(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_ordinary(text), np.int32)

    def encode(self, text: str) -> np.ndarray:
        return self.subtree(text, 0, len(text))

    def subtree(self, text: str, low: int, high: int) -> np.ndarray:
        if high - low <= LEAF:
            return self.leaf(text[low:high])
        middle = (low + high) // 2
        left, right = self.subtree(text, low, middle), self.subtree(text, middle, high)
        if CUT.match(text, middle):
            return np.concatenate([left, right])
        run = LETTER_RUN.fullmatch(text, max(low, middle - RUN_WINDOW), min(high, middle + RUN_WINDOW))
        joined = self.join_in_run(left, right, text, run.start(), middle, run.end()) if run else None
        return self.join_at_cuts(left, right, text, low, middle, high) if joined is None else joined

    def join_at_cuts(self, left: np.ndarray, right: np.ndarray, text: str, low: int, middle: int, high: int) -> np.ndarray:
        start = end = middle
        width = FIRST_WINDOW
        while start == middle:
            first = max(low, middle - width)
            places = [m.start() for m in CUT.finditer(text, max(first, low + 1), middle)]
            start = max([p for p in places if p < middle], default=low if first == low else middle)
            width *= 2
        width = FIRST_WINDOW
        while end == middle:
            last = min(high, middle + width)
            place = next((m.start() for m in CUT.finditer(text, middle + 1, last) if m.start() < last), None)
            end = place or (high if last == high else middle)
            width *= 2
        return np.concatenate([self.without_end(left, text[start:middle]), self.leaf(text[start:end]), self.without_start(right, text[middle:end])])

    def without_end(self, ids: np.ndarray, part: str) -> np.ndarray:
        """Ids before those that spell `part` at the end."""
        size = len(part.encode())
        return ids[: len(ids) - int(np.searchsorted(np.cumsum(self.sizes[ids[: -size - 1 : -1]]), size)) - 1]

    def without_start(self, ids: np.ndarray, part: str) -> np.ndarray:
        size = len(part.encode())
        return ids[int(np.searchsorted(np.cumsum(self.sizes[ids[:size]]), size)) + 1 :]

    def join_in_run(self, left: np.ndarray, right: np.ndarray, text: str, first: int, middle: int, last: int) -> np.ndarray | None:
        """The two sides joined inside a run of letters that reaches from `first` to `last` at least; None if the window
        would leave that stretch."""
        room_left, room_right = len(text[first:middle].encode()), len(text[middle:last].encode())
        a, b = 1, 1  # tokens of either side in the window
        while True:
            raw_left, raw_right = self.spelled(left[len(left) - a :]), self.spelled(right[:b])
            if a >= len(left) or b >= len(right) or len(raw_left) >= room_left or len(raw_right) >= room_right:
                return None
            window = self.merged(raw_left + raw_right)
            fits_left, fits_right = self.neighbours(int(left[-a - 1]), window[0]), self.neighbours(window[-1], int(right[b]))
            if fits_left and fits_right:
                return np.concatenate([left[:-a], np.array(window, np.int32), right[b:]])
            a, b = a if fits_left else 2 * a, b if fits_right else 2 * b

    def neighbours(self, a: int, b: int) -> bool:
        """Whether two tokens are the encoding of their bytes."""
        if (a, b) not in self.stable:
            self.stable[a, b] = self.merged(self.raw[a] + self.raw[b]) == [a, b]
        return self.stable[a, b]

    def merged(self, raw: bytes) -> list[int]:
        """Encoding of the few bytes of a window: the pair of least rank, the first of them, is merged until none is left."""
        parts = [raw[k : k + 1] for k in range(len(raw))]
        while len(parts) > 1:
            rank, k = min((self.ranks.get(parts[k] + parts[k + 1], len(self.raw)), k) for k in range(len(parts) - 1))
            if rank == len(self.raw):
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return [self.ranks[p] for p in parts]

    def spelled(self, ids: np.ndarray) -> bytes:
        """Bytes of some ids, concatenated up a tree."""
        if len(ids) <= LEAF:
            return b"".join([self.raw[k] for k in ids.tolist()])
        return self.spelled(ids[: len(ids) // 2]) + self.spelled(ids[len(ids) // 2 :])


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec per worker, vocabulary and pattern."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def parts_by_bytes(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows of about `BATCH_BYTES` together."""
    part = (np.cumsum(sizes) - sizes) // BATCH_BYTES
    edges = np.flatnonzero(np.diff(part)) + 1
    yield from zip([0, *edges.tolist()], [*edges.tolist(), len(sizes)], strict=True)


def encode(documents: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id and ids, as the vocabulary's ranks and pattern give them, without special tokens."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary, pattern)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for s, e in parts_by_bytes(np.array([len(t) for t in texts.to_pylist()], np.int64)) if len(texts) else ():
                lists = [own.encode(t) for t in texts.slice(s, e - s).to_pylist()]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(lists)))
                yield pa.RecordBatch.from_arrays([keys.slice(s, e - s), ids], names=["doc_id", "ids"])

    docs = documents.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return docs.mapInArrow(rows, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Rows of `encode` with the bytes their ids stand for (raw)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary, pattern)
        for batch in batches:
            keys, ids = batch.column(0), batch.column(1)
            for s, e in parts_by_bytes(np.array([4 * len(x) for x in ids], np.int64)) if len(ids) else ():
                part = ids.slice(s, e - s)
                flat = part.flatten().to_numpy()
                ends = np.cumsum(part.value_lengths().to_numpy())
                raw = [own.spelled(flat[a:b]) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([keys.slice(s, e - s), part, pa.array(raw, pa.binary())], names=["doc_id", "ids", "raw"])

    rows_ = encoded.select("doc_id", "ids")
    return rows_.mapInArrow(rows, f"doc_id {rows_.schema['doc_id'].dataType.simpleString()}, ids array<int>, raw binary")

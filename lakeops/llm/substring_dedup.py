"""Substring dedup of word sequences by fixed-block anchors.

Every text is cut into blocks of `window // 2 + 1` words that do not overlap; these are the index. Any window of `window`
words holds one whole block of its own text, so if it occurs in two texts, then a block of the one is found by a rolling
probe of the other. Each text probes the index with every run of a block's length. Where probes hit, they are extended:
a stretch in which all probes of a window have been seen elsewhere, at least one of them as a block, is a candidate; the
window hashes of candidates are then compared themselves, and overlapping repeats merge to maximal stretches.

Probes go to the index as sorted hashes of chunks (see `chunks`): 40 bits in the first step, where a chance hit costs only a
candidate more, 64 bits in the second. A passage that many documents share is one entry per chunk in either step, and
all a window needs to know is the least document that has it; so no pairs of documents are formed.

A word goes if it lies in a window that also starts in a document of smaller id. Edge cases: NULL or empty text has no
words. Texts shorter than a window keep all. Repetition within one id does not count, also over several rows of that id.
NULL ids come before all others and count as one id.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.chunks import Asked, Chunk, answer, answered, ask, bucket_count, chunk_table, questions, settle
from lakeops.llm.hashing import Words, runs
from lakeops.llm.ranges import real_key
from lakeops.session import materialize

PROBE_BITS = np.uint64(24)  # bits left out of a 64-bit hash


def all_of(flags: np.ndarray, n: int) -> np.ndarray:
    """For each place, whether the `n` flags from it on are all set."""
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[n:] - total[:-n] == n


def any_of(flags: np.ndarray, n: int) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[n:] - total[:-n] > 0


class Probes:
    """The rolling probes of a chunk: distinct hashes in order, whether each is a block and whether it comes twice."""

    def __init__(self, words: Words, window: int):
        self.words, self.window, self.length = words, window, window // 2 + 1
        left = words.left()
        long = np.repeat(words.counts >= window, words.counts)
        self.places = np.flatnonzero(long & (left >= self.length))
        self.hashes = (runs(words.hashes, self.length, self.places) >> PROBE_BITS) << PROBE_BITS
        block = (words.place()[self.places] % self.length == 0).astype(np.uint64)
        entries = np.sort(self.hashes | block)
        keys = entries >> PROBE_BITS << PROBE_BITS
        starts = np.ones(len(keys), bool)
        starts[1:] = keys[1:] != keys[:-1]
        at = np.flatnonzero(starts)
        last = np.append(at[1:], len(keys)) - 1
        self.distinct, self.block, self.twice = keys[at], (entries[last] & np.uint64(1)).astype(bool) if len(at) else np.empty(0, bool), last > at

    def candidates(self, elsewhere: np.ndarray, hit: np.ndarray) -> np.ndarray:
        """Places of windows all of whose probes occur elsewhere and one of them as a block."""
        n = len(self.words.hashes)
        if n < self.window or not len(self.distinct):
            return np.empty(0, np.int64)
        which = np.searchsorted(self.distinct, self.hashes)
        seen, anchored = np.zeros(n, bool), np.zeros(n, bool)
        seen[self.places] = elsewhere[which]
        anchored[self.places] = hit[which]
        probes = self.window - self.length + 1
        found = all_of(seen, probes) & any_of(anchored, probes)
        places = np.flatnonzero(found)
        return places[self.words.left()[places] >= self.window]


class Windows:
    """Candidate windows of a chunk: distinct hashes in order, with the least document of the chunk that has each."""

    def __init__(self, chunk: Chunk, words: Words, places: np.ndarray, window: int):
        self.places = places
        self.docs = chunk.ids[words.text_of()[places]]
        self.hashes = runs(words.hashes, window, places)
        order = np.lexsort((self.docs, self.hashes))
        ordered = self.hashes[order]
        starts = np.ones(len(ordered), bool)
        starts[1:] = ordered[1:] != ordered[:-1]
        self.distinct, self.least = ordered[starts], self.docs[order][starts]

    def repeated(self, smaller_elsewhere: np.ndarray) -> np.ndarray:
        """Places of windows that a document of smaller id has too."""
        which = np.searchsorted(self.distinct, self.hashes)
        return self.places[smaller_elsewhere[which] | (self.docs > self.least[which])]


def repeated_words(documents: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 and `spans`, the removed stretches as (first word, words)."""
    chunks = chunk_table(documents, id_col, text_col)
    buckets = bucket_count(chunks)

    def probe(number: int, chunk: Chunk) -> pd.DataFrame:
        p = Probes(Words(chunk.texts()), window)
        return questions(number, p.distinct, (p.block, p.twice), buckets)

    def look_up(asked: Asked) -> pd.DataFrame:
        block, twice = asked.more
        elsewhere = (asked.asking > 1) | asked.gather(np.logical_or, twice)
        hit = elsewhere & asked.gather(np.logical_or, block)
        return asked.answers(elsewhere[asked.which], hit[asked.which])

    def windows_of(chunk: Chunk, cells: pd.DataFrame) -> tuple[Words, Windows]:
        words = Words(chunk.texts())
        probes = Probes(words, window)
        bits = answered(cells) or [np.empty(0, bool)] * 2
        return words, Windows(chunk, words, probes.candidates(*bits), window)

    def extend(number: int, chunk: Chunk, cells: pd.DataFrame) -> pd.DataFrame:
        _, w = windows_of(chunk, cells)
        return questions(number, w.distinct, (w.least,), buckets)

    def least(asked: Asked) -> pd.DataFrame:
        first = asked.gather(np.minimum, asked.more[0])
        return asked.answers(first[asked.which] < asked.more[0])

    def remove(number: int, chunk: Chunk, cells: pd.DataFrame) -> pd.DataFrame:
        words, w = windows_of(chunk, cells[cells["step"] == 1])
        bits = answered(cells[cells["step"] == 2]) or [np.empty(0, bool)]
        edges = np.zeros(len(words.hashes) + 1, np.int32)
        at = w.repeated(bits[0])
        np.add.at(edges, at, 1)
        np.add.at(edges, at + window, -1)
        gone = np.cumsum(edges[:-1]) > 0
        out = []
        for k, (i, own) in enumerate(zip(chunk.ids, words.lists, strict=True)):
            mask = gone[words.starts[k] : words.starts[k + 1]]
            kept, spans = own, []
            if mask.any():
                kept = [x for x, m in zip(own, mask, strict=True) if not m]
                turns = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
                spans = [{"first": int(s), "words": int(e - s)} for s, e in zip(turns[::2], turns[1::2], strict=True)]
            out.append((i, len(own), len(own) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest(), spans))
        return pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept_sha256", "spans"])

    hits = materialize(answer(ask(chunks, probe), look_up), "probe-answers")
    extended = settle(chunks, hits, extend, "bucket int, chunk bigint, cell binary")
    repeats = answer(extended, least)
    answers = hits.withColumn("step", F.lit(1)).unionByName(repeats.withColumn("step", F.lit(2)))
    out = settle(chunks, answers, remove, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, spans array<struct<first:bigint,words:bigint>>")
    return out.withColumn("doc_id", real_key(F.col("doc_id")))

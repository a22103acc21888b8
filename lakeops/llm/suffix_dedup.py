"""Removal of byte strings that occur more than once, by suffix arrays over the parts of the texts that may repeat.

Windows of `length` bytes are cut into stretches by content: a window belongs to the least hash among its runs of 64
bytes, its anchor, and neighbouring windows with one anchor form a stretch. Equal windows have equal anchors, wherever
they are. So it is enough to compare, anchor by anchor, what stretches there are:

1. Chunks ask the anchors' buckets (see `chunks`) by hashes only. A stretch found twice is all repeated. A stretch that is
   the only one of its anchor is not. Only where one anchor has several different stretches must bytes be compared.
2. Of each different stretch one chunk sends the bytes. The bucket sorts their suffixes (see `suffix_arrays`) and compares
   neighbours: windows with a common prefix of `length` bytes are repeated.
3. Chunks put both together, mark the bytes, and return their documents.

A passage in a third of all documents costs one entry per chunk and is sent once. Where it ends, the differing
surroundings share an anchor, some hundred bytes a document. Of an anchor with more than about `group_bytes` of different
stretches no bytes are sent: chunks ask for the hashes (96 bits) of their windows, which spread over all buckets, and those
told of twice are repeated. Stretches of the other anchors are compared together up to `group_bytes`.

Edge cases: NULL and empty text have no bytes. Windows do not cross documents. Repetition within one document, over
overlapping places as well, counts. Rows with one id are documents of their own. Bytes removed may cut characters: the
kept bytes are hashed as they are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.chunks import Asked, Chunk, answer, answered, ask, bucket_count, buckets_of, chunk_table, pack, questions, settle, unpack
from lakeops.llm.hashing import factors, mixed
from lakeops.llm.ranges import real_key
from lakeops.llm.suffix_arrays import common_prefixes, suffix_array
from lakeops.session import materialize

GRAM = 64
SLICE = 1 << 19
PLACE_BITS = np.uint64(24)
LONGEST = 512
BYTES = factors(256, 64)
STEPS = factors(8, 65)
WINDOW_BYTES = factors(512, 66).reshape(2, 256)
WINDOW_STEPS = factors(64, 67).reshape(2, 32)
SEPARATOR = b"\xff"  # never part of UTF-8


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 64 bytes from each place on."""
    h, size = BYTES[data], 1
    for step in STEPS[:6]:
        h = h[:-size] * step + h[size:]
        size *= 2
    return mixed(h)


def window_hashes(data: np.ndarray, length: int) -> list[np.ndarray]:
    """Two independent hashes of the `length` bytes from each place on."""
    out = []
    for table, steps in zip(WINDOW_BYTES, WINDOW_STEPS, strict=True):
        h, size, k = table[data], 1, 0
        while size * 2 <= length:
            h, size, k = h[:-size] * steps[k] + h[size:], size * 2, k + 1
        rest = length - size
        out.append(mixed(h[: len(h) - rest] * steps[-1] + h[rest:]))
    return out


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


class Stretches:
    """Stretches of a chunk: `first` window, number of `windows`, `anchor`, `content` hash, whether the anchor comes again in it."""

    def __init__(self, chunk: Chunk, length: int):
        self.chunk, self.length = chunk, length
        data = np.frombuffer(chunk.data, np.uint8)
        n = len(data)
        firsts, anchors, inner = [], [], []
        ends = np.maximum(chunk.starts[1:] - length + 1, chunk.starts[:-1])
        for a in range(0, max(0, n - length + 1), SLICE):
            b = min(a + SLICE, n - length + 1)
            grams = gram_hashes(data[a : b + length - 1])
            packed = grams >> PLACE_BITS << PLACE_BITS | np.arange(len(grams), dtype=np.uint64)
            least = sliding_least(packed, length - GRAM + 1)
            anchor = least >> PLACE_BITS
            begins = np.ones(b - a, bool)
            begins[1:] = anchor[1:] != anchor[:-1]
            edges = np.concatenate([chunk.starts[:-1], ends])
            edges = edges[(edges >= a) & (edges < b)]
            begins[edges - a] = True
            moved = np.zeros(b - a, bool)
            moved[1:] = least[1:] != least[:-1]
            at = np.flatnonzero(begins)
            moves = np.cumsum(moved)
            last = np.append(at[1:], b - a) - 1
            firsts.append(at + a)
            anchors.append(anchor[at])
            inner.append(moves[last] > moves[at])
        join = lambda x, kind: np.concatenate(x) if x else np.empty(0, kind)
        first, anchor, again = join(firsts, np.int64), join(anchors, np.uint64), join(inner, bool)
        windows = np.append(first[1:], max(0, n - length + 1))[: len(first)] - first
        doc = np.searchsorted(chunk.starts, first, side="right") - 1
        held = first < ends[doc] if len(first) else np.empty(0, bool)
        first, anchor, again, windows = first[held], anchor[held], again[held], windows[held]
        if (windows > LONGEST).any():
            times = -(-windows // LONGEST)
            part = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            first, windows = np.repeat(first, times) + part * LONGEST, np.minimum(np.repeat(windows, times) - part * LONGEST, LONGEST)
            anchor, again = np.repeat(anchor, times), np.repeat(again, times)
        # least hashes are all small: mixed again, so that they spread over the buckets
        self.first, self.windows, self.anchor, self.again = first, windows, mixed(anchor) >> PLACE_BITS << PLACE_BITS, again
        text = chunk.data
        content = [hashlib.blake2b(text[s : s + w + length - 1], digest_size=8).digest() for s, w in zip(first.tolist(), windows.tolist(), strict=True)]
        self.content = np.frombuffer(b"".join(content), np.uint64)
        # different contents in order of anchor and content; `entry` is a stretch of each, `which` the place of each stretch
        order = np.lexsort((self.content, self.anchor))
        starts = np.ones(len(order), bool)
        starts[1:] = (self.anchor[order][1:] != self.anchor[order][:-1]) | (self.content[order][1:] != self.content[order][:-1])
        self.entry = order[starts]
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(starts) - 1
        self.times = np.bincount(self.which, minlength=len(self.entry)).astype(np.uint32)

    def bytes_of(self, k: int) -> bytes:
        return self.chunk.data[self.first[k] : self.first[k] + self.windows[k] + self.length - 1]


class HotWindows:
    """Windows of the stretches `entries`: places, their distinct hashes in order with a check and times, `which` of each place."""

    def __init__(self, s: Stretches, entries: np.ndarray):
        first, windows = s.first[entries], s.windows[entries]
        self.at = np.repeat(first - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
        data = np.frombuffer(s.chunk.data, np.uint8)
        h, check = np.empty(len(self.at), np.uint64), np.empty(len(self.at), np.uint32)
        for a in range(0, len(data) if len(self.at) else 0, SLICE):
            here = np.flatnonzero((self.at >= a) & (self.at < a + SLICE))
            if len(here):
                one, two = window_hashes(data[a : a + SLICE + s.length - 1], s.length)
                h[here], check[here] = one[self.at[here] - a], two[self.at[here] - a] >> np.uint64(32)
        order = np.lexsort((check, h))
        starts = np.ones(len(order), bool)
        starts[1:] = (h[order][1:] != h[order][:-1]) | (check[order][1:] != check[order][:-1])
        self.hashes, self.check = h[order[starts]], check[order[starts]]
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(starts) - 1
        self.times = np.minimum(np.bincount(self.which, minlength=len(self.hashes)), 2).astype(np.uint8)


def window_answers(asked: Asked) -> pd.DataFrame:
    """Per entry: whether the window is told of twice."""
    check, times = asked.more
    order = np.lexsort((check, asked.which))
    starts = np.ones(len(order), bool)
    starts[1:] = (asked.which[order][1:] != asked.which[order][:-1]) | (check[order][1:] != check[order][:-1])
    total = np.add.reduceat(times[order].astype(np.int64), np.flatnonzero(starts))
    twice = np.empty(len(order), bool)
    twice[order] = total[np.cumsum(starts) - 1] > 1
    return asked.answers(twice)


def stretch_answers(asked: Asked, most: int) -> pd.DataFrame:
    """Per entry: found twice, and whether this chunk is the one to ask for its windows, or to send it.

    Windows are asked for where the anchor has more than `most` different stretches.
    """
    content, times, again = asked.more
    order = np.lexsort((content, asked.which))
    anchor, c = asked.which[order], content[order]
    starts = np.ones(len(order), bool)
    starts[1:] = (anchor[1:] != anchor[:-1]) | (c[1:] != c[:-1])
    at = np.flatnonzero(starts)
    total = np.add.reduceat(times[order].astype(np.int64), at)
    different = np.bincount(anchor[at], minlength=len(asked.hashes))
    group = np.cumsum(starts) - 1
    twice, compare, own = (np.empty(len(order), bool) for _ in range(3))
    twice[order] = total[group] > 1
    compare[order] = different[anchor] > 1
    compare |= again
    own[order] = starts
    hot = different[asked.which] > most
    return asked.answers(twice, own & hot, own & compare & ~hot)


def repeated_windows(contents: list[tuple[int, bytes]], length: int) -> np.ndarray:
    """Flags of all windows of the contents, (windows, bytes) each, that occur more than once among them."""
    data = b"".join(part for _, c in contents for part in (c, SEPARATOR))
    order = suffix_array(data, length)
    same = np.flatnonzero(common_prefixes(data, order, length) >= length)
    flags = np.zeros(len(data) + 1, bool)
    flags[order[same]] = True
    flags[order[same + 1]] = True
    starts = np.cumsum([0, *[len(c) + 1 for _, c in contents]])
    return np.concatenate([flags[s : s + w] for s, (w, _) in zip(starts, contents, strict=False)])


def removed_bytes(documents: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", group_bytes: int = 1 << 20) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and `spans`, the removed stretches as (first, bytes)."""
    if length < 2 * GRAM:
        raise ValueError(f"length is {2 * GRAM} at least")
    chunks = chunk_table(documents, id_col, text_col)
    buckets = bucket_count(chunks)

    def ask_stretches(number: int, chunk: Chunk) -> pd.DataFrame:
        s = Stretches(chunk, length)
        return questions(number, s.anchor[s.entry], (s.content[s.entry], s.times, s.again[s.entry]), buckets)

    def send(number: int, chunk: Chunk, cells: pd.DataFrame) -> pd.DataFrame:
        s = Stretches(chunk, length)
        twice, hot, own = answered(cells) or [np.empty(0, bool)] * 3
        picked = np.flatnonzero(own)
        anchors = s.anchor[s.entry[picked]]
        at = buckets_of(anchors, buckets)
        rows = []
        for k, (b, e) in enumerate(zip(at[:-1], at[1:], strict=True)):
            if e > b:
                own_bytes = b"".join(s.bytes_of(j) for j in s.entry[picked[b:e]])
                rows.append((k, number, pack(anchors[b:e], s.windows[s.entry[picked[b:e]]], picked[b:e], twice[picked[b:e]], np.frombuffer(own_bytes, np.uint8))))
        sent = pd.DataFrame(rows, columns=["bucket", "chunk", "cell"])
        if not hot.any():
            return sent
        # windows go to buckets of their own, numbered behind those of the anchors
        windows = HotWindows(s, s.entry[hot])
        asks = questions(number, windows.hashes, (windows.check, windows.times), buckets)
        return pd.concat([sent, asks.assign(bucket=asks["bucket"] + buckets)], ignore_index=True)

    def told(group: pd.DataFrame) -> pd.DataFrame:
        return window_answers(Asked(group)) if group["bucket"].iloc[0] >= buckets else compare(group)

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("chunk")
        cells = [unpack(c) for c in group["cell"]]
        anchor, windows, entry, twice, raw = (np.concatenate([c[k] for c in cells]) for k in range(5))
        chunk = np.repeat(group["chunk"].to_numpy(), [len(c[0]) for c in cells])
        ends = np.cumsum(windows + length - 1)
        begins = ends - (windows + length - 1)
        raw = raw.tobytes()
        order = np.argsort(anchor, kind="stable")
        out, batch, held = [], [], 0

        def settle_batch() -> None:
            flags = repeated_windows([(int(windows[k]), raw[begins[k] : ends[k]]) for k in batch], length)
            done = 0
            for k in batch:
                own = flags[done : done + windows[k]]
                done += windows[k]
                if not twice[k] and own.any():
                    turns = np.flatnonzero(np.diff(own.astype(np.int8), prepend=0, append=0))
                    out.extend((chunk[k], entry[k], s, e) for s, e in zip(turns[::2], turns[1::2], strict=True))

        for j, k in enumerate(order):
            if held > group_bytes and anchor[k] != anchor[order[j - 1]]:
                settle_batch()
                batch, held = [], 0
            batch.append(k)
            held += ends[k] - begins[k]
        if batch:
            settle_batch()
        found = pd.DataFrame(out, columns=["chunk", "entry", "from", "to"]).astype(np.int64)
        rows = [(int(c), int(group["bucket"].iloc[0]), pack(*[f[x].to_numpy() for x in ("entry", "from", "to")])) for c, f in found.groupby("chunk")]
        return pd.DataFrame(rows, columns=["chunk", "bucket", "cell"])

    def remove(number: int, chunk: Chunk, cells: pd.DataFrame) -> pd.DataFrame:
        s = Stretches(chunk, length)
        twice, hot, _ = answered(cells[cells["step"] == 1]) or [np.empty(0, bool)] * 3
        entry, begin, end = answered(cells[cells["step"] == 2]) or [np.empty(0, np.int64)] * 3
        edges = np.zeros(len(chunk.data) + 1, np.int32)
        full = np.flatnonzero(twice[s.which])
        np.add.at(edges, s.first[full], 1)
        np.add.at(edges, s.first[full] + s.windows[full] + length - 1, -1)
        at = s.first[s.entry[entry]]
        np.add.at(edges, at + begin, 1)
        np.add.at(edges, at + end + length - 1, -1)
        if hot.any():
            windows = HotWindows(s, s.entry[hot])
            at = windows.at[answered(cells[cells["step"] == 3])[0][windows.which]]
            np.add.at(edges, at, 1)
            np.add.at(edges, at + length, -1)
        gone = np.cumsum(edges[:-1]) > 0
        data, out = np.frombuffer(chunk.data, np.uint8), []
        for i, b, e in zip(chunk.ids, chunk.starts[:-1], chunk.starts[1:], strict=True):
            mask = gone[b:e]
            if mask.any():
                turns = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
                spans = [{"first": int(x), "bytes": int(y - x)} for x, y in zip(turns[::2], turns[1::2], strict=True)]
                out.append((i, e - b, int(mask.sum()), len(spans), hashlib.sha256(data[b:e][~mask].tobytes()).hexdigest(), spans))
            else:
                out.append((i, e - b, 0, 0, hashlib.sha256(chunk.data[b:e]).hexdigest(), []))
        return pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    known = materialize(answer(ask(chunks, ask_stretches), lambda asked: stretch_answers(asked, group_bytes // length)), "stretch-answers")
    sent = settle(chunks, known, send, "bucket int, chunk bigint, cell binary")
    compared = sent.groupBy("bucket").applyInPandas(told, "chunk bigint, bucket int, cell binary")
    answers = known.withColumn("step", F.lit(1)).unionByName(compared.withColumn("step", F.when(F.col("bucket") < buckets, 2).otherwise(3)))
    out = settle(chunks, answers, remove, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<first:bigint,bytes:bigint>>")
    return out.withColumn("doc_id", real_key(F.col("doc_id")))

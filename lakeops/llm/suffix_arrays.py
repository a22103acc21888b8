"""Suffix arrays by two-stage sorting, over numpy arrays.

A suffix is small if it is less than the one that begins a byte later, else large. Only small suffixes are sorted
directly. The large ones follow from them by one scan over the buckets of first bytes in ascending order: when a bucket
is complete, the bytes before its suffixes tell the order of the large suffixes of all later buckets. Suffixes are told
apart up to a depth of `depth` bytes at least; common prefixes of neighbours are compared up to it.
"""

from __future__ import annotations

import numpy as np


def small_suffixes(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is less than the next; the last is not, as the end is less than all."""
    n = len(text)
    step = np.append(np.sign(text[1:].astype(np.int16) - text[:-1]), -1)
    turns = np.flatnonzero(step)
    return step[turns[np.searchsorted(turns, np.arange(n))]] > 0


def leading_words(data: bytes, n: int) -> np.ndarray:
    """The eight bytes from each place on as a number in the order of the bytes."""
    padded = np.frombuffer(data + b"\0" * 8, np.uint8)
    out = np.zeros(n, np.uint64)
    for j in range(8):
        out = (out << np.uint64(8)) | padded[j : j + n]
    return out


def sorted_directly(data: bytes, words: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """`places` in the order of their suffixes: by eight bytes at once, then equal ones by what follows."""
    order = places[np.argsort(words[places], kind="stable")]
    same = words[order]
    edges = np.flatnonzero(np.concatenate([[True], same[1:] != same[:-1], [True]]))
    for s in np.flatnonzero(np.diff(edges) > 1):
        group = order[edges[s] : edges[s + 1]]
        order[edges[s] : edges[s + 1]] = sorted(group.tolist(), key=lambda i: data[i : i + depth])
    return order


def suffix_array(data: bytes, depth: int) -> np.ndarray:
    """Places of all suffixes in order."""
    text = np.frombuffer(data, np.uint8)
    n = len(text)
    if n == 0:
        return np.empty(0, np.int64)
    small = small_suffixes(text)
    direct = sorted_directly(data, leading_words(data, n), np.flatnonzero(small), depth)
    cuts = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[n - 1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        found = np.concatenate(waiting[c]) if waiting[c] else np.empty(0, np.int64)
        bucket = []
        while len(found):
            bucket.append(found)
            before = found[found > 0] - 1
            found = before[text[before] == c]
        bucket.append(direct[cuts[c] : cuts[c + 1]])
        full = np.concatenate(bucket)
        out.append(full)
        before = full[full > 0] - 1
        first = text[before]
        before, first = before[first > c], first[first > c]
        if len(before):
            order = np.argsort(first, kind="stable")
            before, first = before[order], first[order]
            edges = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1], [True]]))
            for s, e in zip(edges[:-1], edges[1:], strict=True):
                waiting[first[s]].append(before[s:e])
    return np.concatenate(out)


def common_prefixes(data: bytes, order: np.ndarray, depth: int) -> np.ndarray:
    """Length of the prefix each suffix of `order` shares with the next one, up to `depth`; eight bytes at a time."""
    n = len(data)
    words = leading_words(data + b"\0" * depth, n + depth)
    left, right = order[:-1], order[1:]
    shared = np.zeros(len(left), np.int64)
    open_ = np.arange(len(left))
    for d in range(0, depth, 8):
        a, b = words[left[open_] + d], words[right[open_] + d]
        same = a == b
        shared[open_[same]] = d + 8
        ends = open_[~same]
        if len(ends):
            differing = (a ^ b)[~same]
            high = np.zeros(len(ends), np.int64)
            for j in range(8):
                high += (high == j) & ((differing >> np.uint64(56 - 8 * j)) & np.uint64(255) == 0)
            shared[ends] = d + high
        open_ = open_[same]
        if not len(open_):
            break
    return np.minimum(np.minimum(shared, depth), np.minimum(n - left, n - right))

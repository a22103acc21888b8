"""Hashes of words and of runs of words, as numpy arrays over many documents at once."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd

MIX = np.uint64(0x9E3779B97F4A7C15)


def factors(n: int, seed: int) -> np.ndarray:
    """`n` odd 64-bit numbers that depend on the seed only."""
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX
    return x ^ (x >> np.uint64(29))


class Words:
    """Words of some texts one after the other: `hashes` of all, and `starts` of each text's first word."""

    def __init__(self, texts: Iterable[bytes], lower: bool = False):
        self.lists = [(t.lower() if lower else t).split() for t in texts]
        self.starts = np.concatenate([[0], np.cumsum([len(x) for x in self.lists])]).astype(np.int64)
        flat = np.empty(self.starts[-1], dtype=object)
        flat[:] = [w for x in self.lists for w in x]
        self.hashes = pd.util.hash_array(flat, categorize=False) if len(flat) else np.empty(0, np.uint64)
        self.counts = np.diff(self.starts)

    def left(self) -> np.ndarray:
        """For each word, how many words its text has from it on."""
        return np.repeat(self.starts[1:], self.counts) - np.arange(len(self.hashes))

    def place(self) -> np.ndarray:
        """For each word, its place in its text, from 0."""
        return np.arange(len(self.hashes)) - np.repeat(self.starts[:-1], self.counts)

    def text_of(self) -> np.ndarray:
        """For each word, the number of its text."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def runs(hashes: np.ndarray, n: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hash of the `n` words from each place on (or from the places `at`); places too near the end give no sense."""
    by = factors(n, n)
    size = max(0, len(hashes) - n + 1)
    if at is not None:
        out = np.zeros(len(at), np.uint64)
        for j in range(n):
            out += hashes[at + j] * by[j]
        return mixed(out)
    out = np.zeros(size, np.uint64)
    for j in range(n):
        out += hashes[j : j + size] * by[j]
    return mixed(out)

"""Lattices of vocabulary pieces over many words at once, as numpy arrays.

A text is `▁` for each space, with one before it, as the vocabulary's own encoder reads it; it is cut into words
where no piece can cross: before a run of `▁` and around line feeds. A word's nodes are its characters and its end, an edge
is a piece that stands there. Characters without a piece are an edge that is written as their bytes.

The probability of a piece falls with its rank in the vocabulary (Zipf's law; ids are in the order of merges), raised to
`alpha`. Sums over all ways from each node to the end of the word turn that into the chance of each edge from its node, so
a way drawn edge by edge is a segmentation drawn from the lattice, and the lattice of a text is its words' one after the other.

A word's lattice depends on the word only. Those of words met in a second batch of texts are remembered, up to about
`REMEMBERED_CHARS` characters of words; then all are forgotten.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lakeops.llm.hashing import factors

SPACE = "▁"
WORD = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")
STEP, START = factors(2, 70)
SIEVE_BITS = 16
SHORT = 7
#: Each takes some hundred bytes of edges, nodes and words.
REMEMBERED_CHARS = 1_500_000
SEEN_BITS = 22


def spaced(text: str) -> str:
    """The words of a text, as `WORD` cuts them, between spaces; most texts can be cut at single spaces and line feeds alone."""
    if not text:
        return ""
    if "  " in text or SPACE in text or text[0] == " ":
        return " ".join(WORD.findall(SPACE + text.replace(" ", SPACE)))
    return (SPACE + text.replace(" ", f" {SPACE}")).replace("\n", " \n ")


def words_of(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The different words of some texts, which of them each word is, and how many words each text has."""
    lists = pc.split_pattern(pa.array([spaced(t) for t in texts], pa.large_string()), " ")
    coded = lists.flatten().dictionary_encode()
    which, different = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    counts = np.diff(lists.offsets.to_numpy())
    if "" not in different:
        return different, which, counts
    # nothing stands between two line feeds, and at the ends of texts
    none = different.index("")
    there = which != none
    counts = np.bincount(np.repeat(np.arange(len(texts)), counts)[there], minlength=len(texts))
    which = which[there]
    return different[:none] + different[none + 1 :], which - (which > none), counts


class Pieces:
    """Pieces of a sentencepiece vocabulary with their log weights, to be found by hash of their characters."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names, ids = [], []
        self.bytes_first = -1
        self.raw: list[bytes] = []
        for i in range(model.get_piece_size()):
            name = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes_first = i if self.bytes_first < 0 else self.bytes_first
                self.raw.append(bytes([int(name[3:5], 16)]))
            else:
                self.raw.append(b"" if model.is_control(i) or model.is_unknown(i) else name.encode())
                if self.raw[-1]:
                    names.append(name)
                    ids.append(i)
        rank = np.arange(1, len(ids) + 1)
        total = np.log(np.sum(1 / (rank + 1.0)) + 256 / (len(ids) + 2.0))
        weights = alpha * (-np.log(rank + 1.0) - total)
        self.byte_weight = alpha * (-np.log(len(ids) + 2.0) - total)
        self.weights = np.full(model.get_piece_size(), -np.inf)
        self.weights[ids] = weights
        # for each length from long to short: hashes in order, their ids, and by leading bits the first of the hashes (-1: none)
        self.known = Known()
        self.lengths: list[int] = []
        self.tables: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        lengths = np.array([len(n) for n in names])
        # for each length, by leading bits of the hash of that many characters, whether longer pieces may begin so
        self.goes_on = np.zeros((lengths.max(initial=1) + 1, 1 << SIEVE_BITS), bool)
        for n in np.unique(np.append(lengths, 1))[::-1]:
            at = np.flatnonzero(lengths == n)
            chars = np.frombuffer("".join(names[k] for k in at).encode("utf-32-le"), np.uint32).reshape(len(at), n)
            h = np.full(len(at), START, np.uint64)
            for j in range(n):
                h = (h ^ chars[:, j]) * STEP
                h ^= h >> np.uint64(32)
                if j + 1 < n:
                    self.goes_on[j + 1, h >> np.uint64(64 - SIEVE_BITS)] = True
            order = np.argsort(h)
            sieve = np.full(1 << SIEVE_BITS, -1, np.int32)
            sieve[h[order][::-1] >> np.uint64(64 - SIEVE_BITS)] = np.arange(len(order))[::-1]
            self.lengths.append(int(n))
            self.tables.append((h[order], np.array(ids, np.int64)[at][order], sieve))

    def find(self, length: int, h: np.ndarray, fits: np.ndarray | bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes that fit are of pieces of that length, and these pieces."""
        known, piece, sieve = self.tables[self.lengths.index(length)]
        at = sieve[h >> np.uint64(64 - SIEVE_BITS)]
        maybe = np.flatnonzero((at >= 0) & fits)
        at, h = at[maybe], h[maybe]
        # several pieces may have the same leading bits
        wait = np.flatnonzero(known[at] < h)
        while len(wait):
            at[wait] += 1
            wait = wait[at[wait] < len(known)]
            wait = wait[known[at[wait]] < h[wait]]
        at = np.minimum(at, len(known) - 1)
        hit = known[at] == h
        return maybe[hit], piece[at[hit]]


class Lattices:
    """Lattices of the given words. Node of word k: `first[k]` on; edges of node v: `at[v]` to `at[v + 1]`, long pieces first.

    Of edges: `end` node, `piece` id (-1: bytes of the character), `log_p` given its node, `upto` the sum of the chances of
    the node's edges up to it. `done` tells the nodes at the end of a word.
    """

    def __init__(self, words: list[str], pieces: Pieces):
        self.chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        offsets = np.cumsum(sizes) - sizes
        self.first = offsets + np.arange(len(words))
        n, nodes = len(self.chars), len(self.chars) + len(words)
        node = np.arange(n) + np.repeat(np.arange(len(words)), sizes)
        left = np.repeat(offsets + sizes, sizes) - np.arange(n)

        # pieces at each character: short ones by length in rows, long to short, the few long ones in a list
        short = [x for x in pieces.lengths if x <= SHORT]
        lengths = np.array(short)
        found = np.full((len(short), n), -2, np.int32)
        long_char, long_piece, long_length = [], [], []
        h, where = np.full(n, START, np.uint64), np.arange(n)
        for length in range(1, max(pieces.lengths) + 1):
            h = h ^ self.chars[where + (length - 1)]
            h *= STEP
            h ^= h >> np.uint64(32)
            if length in pieces.lengths:
                hit, piece = pieces.find(length, h)
                if length <= SHORT:
                    found[short.index(length), where[hit]] = piece
                else:
                    long_char.append(where[hit])
                    long_piece.append(piece.astype(np.int32))
                    long_length.append(np.full(len(hit), length))
            # only where a longer piece may begin, and the word goes on
            on = np.flatnonzero(pieces.goes_on[length][h >> np.uint64(64 - SIEVE_BITS)] & (left[where] > length))
            where, h = where[on], h[on]
            if not len(where):
                break
        join = lambda x, kind: np.concatenate(x[::-1]) if x else np.empty(0, kind)
        long_char, long_piece, long_length = join(long_char, np.int64), join(long_piece, np.int32), join(long_length, np.int64)
        odd = found[-1] == -2
        found[-1, odd] = -1
        weight_of = np.append(pieces.weights, [-np.inf, 0.0]).astype(np.float32)
        weight = weight_of[found]
        c = self.chars[odd]
        odd_weight = (pieces.byte_weight * (1 + (c > 0x7F).astype(np.int64) + (c > 0x7FF) + (c > 0xFFFF))).astype(np.float32)
        weight[-1, odd] = odd_weight
        long_weight = pieces.weights[long_piece]

        # log of the sum over all ways from each node to the end of its word, from the last character back
        ahead = np.zeros(nodes)
        by_left = lambda x: np.argsort(x.astype(np.uint16) if len(x) and x.max() < 1 << 16 else x, kind="stable")
        order, long_order = by_left(left), by_left(left[long_char])
        ends = np.arange(1, (int(left.max()) if n else 0) + 2)
        cuts, long_cuts = np.searchsorted(left[order], ends), np.searchsorted(left[long_char[long_order]], ends)
        from_back, at_node = weight[:, order], node[order]
        for rest in range(1, len(ends)):
            s, e = cuts[rest - 1], cuts[rest]
            fits = np.count_nonzero(lengths > rest)
            way = from_back[fits:, s:e] + ahead[at_node[s:e] + lengths[fits:, None]]
            top = way.max(axis=0)
            way -= top
            ahead[at_node[s:e]] = top + np.log(np.exp(way, out=way).sum(axis=0))
            more = long_order[long_cuts[rest - 1] : long_cuts[rest]]
            if len(more):
                at = node[long_char[more]]
                np.logaddexp.at(ahead, at, long_weight[more] + ahead[at + long_length[more]])

        there = np.ascontiguousarray((found >= -1).T)
        char = np.repeat(np.arange(n), np.count_nonzero(found >= -1, axis=0))
        piece, length = np.ascontiguousarray(found.T)[there], np.broadcast_to(lengths.astype(np.int16), there.shape)[there]
        w = weight_of[piece].astype(np.float64)
        w[piece == -1] = odd_weight
        if len(long_char):
            order = np.argsort(long_char, kind="stable")
            at = np.searchsorted(char, long_char[order]) + np.arange(len(order))
            short_at = np.ones(len(char) + len(order), bool)
            short_at[at] = False
            short_at = np.flatnonzero(short_at)

            def both(x: np.ndarray, y: np.ndarray) -> np.ndarray:
                out = np.empty(len(x) + len(y), x.dtype)
                out[short_at], out[at] = x, y[order]
                return out

            char, piece, length, w = both(char, long_char), both(piece, long_piece), both(length, long_length), both(w, long_weight)
        self.char, self.piece = char.astype(np.int32), piece
        start = node[char]
        self.end = start + length
        counts = np.bincount(start, minlength=nodes)
        self.log_p = w + ahead[self.end] - np.repeat(ahead, counts)
        self.at = np.concatenate([[0], np.cumsum(counts)])
        total = np.cumsum(np.exp(self.log_p))
        self.upto = total - np.repeat(np.concatenate([[0.0], total])[self.at[:-1]], counts)
        last = self.at[1:][self.at[1:] > self.at[:-1]] - 1
        self.upto[last] = 2.0
        self.done = np.zeros(nodes, bool)
        self.done[self.first + sizes] = True


class Known:
    """Lattices of the words met so far in more than one batch, and behind them those of one batch; attributes as of `Lattices`."""

    def __init__(self):
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.seen = np.zeros(1 << SEEN_BITS, bool)  # by hash; words taken for others are remembered one batch early
        self.n_chars = self.n_nodes = self.n_edges = self.all_nodes = 0
        self.chars, self.first = np.empty(0, np.uint32), np.empty(0, np.int64)
        self.at, self.done = np.zeros(1, np.int64), np.empty(0, bool)
        self.piece, self.char, self.end = (np.empty(0, np.int32) for _ in range(3))
        self.log_p, self.upto = np.empty(0), np.empty(0)

    def codes(self, words: list[str], pieces: Pieces) -> np.ndarray:
        """For each of the different words of a batch, the number of its lattice, until the next batch is asked for."""
        if self.n_chars > REMEMBERED_CHARS or len(self.chars) > 4 * REMEMBERED_CHARS:
            self.forget()
        code = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(code < 0)
        if len(new):
            slot = np.fromiter((hash(words[k]) for k in new.tolist()), np.int64, len(new)) & ((1 << SEEN_BITS) - 1)
            again = self.seen[slot]
            self.seen[slot] = True
            new = np.concatenate([new[again], new[~again]])
            code[new] = len(self.place) + np.arange(len(new))
            self.append([words[k] for k in new.tolist()], int(again.sum()), pieces)
        return code

    def append(self, words: list[str], remembered: int, pieces: Pieces) -> None:
        """Adds the words' lattices; all but the first `remembered` give way to the next ones."""
        more = Lattices(words, pieces)
        parts = {
            "chars": (self.n_chars, more.chars), "first": (len(self.place), more.first + self.n_nodes), "at": (self.n_nodes, more.at + self.n_edges), "done": (self.n_nodes, more.done),
            "piece": (self.n_edges, more.piece), "char": (self.n_edges, more.char + self.n_chars), "end": (self.n_edges, more.end + self.n_nodes), "log_p": (self.n_edges, more.log_p), "upto": (self.n_edges, more.upto),
        }
        for name, (have, new) in parts.items():
            kept = getattr(self, name)
            if have + len(new) > len(kept):
                kept = np.empty(have + len(new) + (have + len(new)) // 2, kept.dtype)
                kept[:have] = getattr(self, name)[:have]
                setattr(self, name, kept)
            kept[have : have + len(new)] = new
        self.all_nodes = self.n_nodes + len(more.done)
        nodes = int(more.first[remembered]) if remembered < len(words) else len(more.done)
        self.place.update(zip(words[:remembered], range(len(self.place), len(self.place) + remembered), strict=True))
        self.n_chars, self.n_nodes, self.n_edges = self.n_chars + nodes - remembered, self.n_nodes + nodes, self.n_edges + int(more.at[nodes])

    def nodes_of(self, edges: np.ndarray) -> np.ndarray:
        """The node each edge begins at."""
        return np.searchsorted(self.at[: self.all_nodes + 1], edges, side="right") - 1

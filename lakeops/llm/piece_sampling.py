"""SentencePiece segmentations drawn without replacement, by Gumbel top-k search over the lattice, and their decoding.

All segmentations of a text, each with Gumbel noise on its log-probability: the `samples` greatest are a draw without
replacement. They are found without listing them. The greatest of a subtree is known before the subtree is opened: the
noise of the root is drawn, a node hands its value to one edge drawn by chance, and the other edges together get a value below it. A
best-first search takes the open branch with the greatest value, which is an exact bound, draws which of its edges
continues, and goes to the end of the text without looking back. The search runs for all texts of a batch at once.

Each result has its log-probability and the log of its inclusion score, 1 - exp(-exp(log_p - k)), with k the value of the
best branch not taken, which makes weighted sums over the sample unbiased. All draws are hashes of the row's key, the
place and the number of the result, so results do not depend on how rows are dealt out.

Edge cases: NULL and empty texts have one segmentation, no pieces, log-probability 0. Texts with fewer segmentations than
`samples` give them all. Repeated rows give equal results. The literal character U+2581 is read as a space.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.hashing import factors, mixed
from lakeops.llm.piece_lattice import SPACE, Known, Pieces, words_of
from lakeops.llm.ranges import known_key, real_key

#: Characters searched at once: each takes some hundred bytes of edges, draws and paths.
BATCH_CHARS = 250_000
RESULT = pa.schema({"doc_id": pa.int64(), "rank": pa.int32(), "n_pieces": pa.int64(), "ids": pa.binary(), "ids_crc32": pa.int64(), "log_prob": pa.float64(), "log_inclusion": pa.float64(), "decodes": pa.bool_()})
SALTS = factors(6, 71)
FIRST_NODES = 96
MOST_NOISE = 38.0  # -log(-log(u)) for the greatest u below 1
_pieces: dict[tuple[str, float], Pieces] = {}


def pieces_of(path: str, alpha: float) -> Pieces:
    """One vocabulary per worker."""
    if (path, alpha) not in _pieces:
        _pieces[path, alpha] = Pieces(path, alpha)
    return _pieces[path, alpha]


def uniform(*parts: np.ndarray | int) -> np.ndarray:
    """Numbers in (0, 1) that depend on all of `parts` only."""
    return spread(hashed(np.uint64(0), 0, *parts))


def hashed(h: np.ndarray | np.uint64, first: int, *parts: np.ndarray | int) -> np.ndarray:
    """The hash `h` of `first` parts, continued by more of them."""
    for salt, part in zip(SALTS[first:], parts, strict=False):
        h = mixed((h ^ np.asarray(part).astype(np.uint64)) * salt + salt)
    return h


def spread(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54


def gumbel(u: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(u))


def below(location: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """A Gumbel variable of that location given that it is below `bound`."""
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        out = location - np.log(np.exp(np.minimum(location - bound, 700.0)) - np.log(u))
    return np.where(np.isneginf(location), -np.inf, np.minimum(out, bound))


def rest(log_p: np.ndarray) -> np.ndarray:
    """Log of what is left of 1."""
    with np.errstate(divide="ignore"):
        return np.log(np.maximum(-np.expm1(np.minimum(log_p, 0.0)), 0.0))


class Batch:
    """The words of some texts: `kind` gives each word's lattice, `starts` each text's first word."""

    def __init__(self, texts: list[str], pieces: Pieces):
        words, which, counts = words_of(texts)
        self.kind = pieces.known.codes(words, pieces)[which]
        self.starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.starts))
        self.lattices = pieces.known if len(self.kind) else None

    def walk(self, word: np.ndarray, node: np.ndarray, keys: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Edges drawn from `node` to the end of each of the words, in order: (index into `word`, edge)."""
        lat = self.lattices
        doc = self.doc[word]
        place = word - self.starts[doc]
        seed = hashed(np.uint64(0), 0, mixed(keys[doc] + place.astype(np.uint64) * SALTS[0]), number)
        which, edges, steps = [], [], []
        on, step = np.flatnonzero(~lat.done[node]), 0
        on = on[np.argsort(node[on])]  # equal words one after the other
        node = node[on]
        while len(on):
            u = spread(hashed(seed[on], 2, step))
            edge = lat.at[node]
            wait = np.flatnonzero(u > lat.upto[edge])
            while len(wait):
                edge[wait] += 1
                wait = wait[u[wait] > lat.upto[edge[wait]]]
            which.append(on)
            edges.append(edge)
            steps.append(np.full(len(on), step, np.int32))
            node = lat.end[edge]
            open_ = ~lat.done[node]
            on, node, step = on[open_], node[open_], step + 1
        if not which:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        which, edges, steps = np.concatenate(which), np.concatenate(edges), np.concatenate(steps)
        count = np.bincount(which, minlength=len(word))
        out = np.empty((2, len(which)), np.int64)
        at = (np.cumsum(count) - count)[which] + steps
        out[0, at], out[1, at] = which, edges
        return out[0], out[1]


class Path:
    """One segmentation of each of some texts: `edges` in order, `starts` of each text, and the open branches beside them."""

    def __init__(self, docs: int, word: np.ndarray, edge: np.ndarray, doc: np.ndarray, log_p: np.ndarray):
        self.word, self.edge, self.doc = word, edge, doc
        self.counts = np.bincount(doc, minlength=docs)
        self.starts = np.cumsum(self.counts) - self.counts
        chosen = log_p[edge]
        total = np.concatenate([[0.0], np.cumsum(chosen)])
        self.before = total[:-1] - np.repeat(total[self.starts], self.counts)  # log-probability of the way to each node
        self.log_p = np.bincount(doc, chosen, docs)
        self.value = np.full(len(edge), -np.inf)


def open_values(path: Path, log_p: np.ndarray, keys: np.ndarray, bound: np.ndarray, rank: int, since: np.ndarray, keep: int) -> np.ndarray:
    """Values of the branches beside a path, behind place `since` of each text, as far as they can be among the `keep` greatest.

    The way to a node only gets less likely along a text, and noise adds less than `MOST_NOISE`; so behind the first
    nodes those are left out that cannot reach the `keep`th value found there.
    """
    docs = len(path.counts)
    place = np.arange(len(path.edge)) - path.starts[path.doc]
    behind = place - since[path.doc] - 1
    value = np.full(len(path.edge), -np.inf)

    def fill(at: np.ndarray) -> None:
        d = path.doc[at]
        location = path.before[at] + rest(log_p[path.edge[at]])
        value[at] = below(location, bound[d], uniform(keys[d], rank, 2, place[at]))

    first = np.flatnonzero((behind >= 0) & (behind < FIRST_NODES))
    fill(first)
    table = np.full((docs, FIRST_NODES), -np.inf)
    table[path.doc[first], behind[first]] = value[first]
    least = np.partition(table, FIRST_NODES - keep, axis=1)[:, FIRST_NODES - keep] if keep < FIRST_NODES else np.full(docs, -np.inf)
    fill(np.flatnonzero((behind >= FIRST_NODES) & (path.before + MOST_NOISE >= least[path.doc])))
    return value


def best_of(path: Path, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text, the greatest value of its open branches and where it is."""
    value, at = np.full(docs, -np.inf), np.zeros(docs, np.int64)
    some = np.flatnonzero(path.counts)
    if len(some):
        value[some] = np.maximum.reduceat(path.value, path.starts[some])
        hits = np.flatnonzero(path.value == value[path.doc])
        at[path.doc[hits[::-1]]] = hits[::-1]
    return value, at


def search(batch: Batch, keys: np.ndarray, samples: int) -> list[dict]:
    """For each rank, per text that has one: its number, its edges, log-probability, value; and the bound of the best open branch."""
    docs = len(keys)
    lat = batch.lattices
    empty = np.empty(0, np.int64)
    word = np.arange(len(batch.kind))
    which, edge = batch.walk(word, lat.first[batch.kind], keys, 0) if lat else (empty, empty)
    log_p = lat.log_p if lat else np.empty(0)
    path = Path(docs, which, edge, batch.doc[which], log_p)
    bound = gumbel(uniform(keys, 1))
    there = np.ones(docs, bool)
    paths, results, branches = [], [], []
    for rank in range(samples):
        since = branches[-1]["index"] if rank else np.full(docs, -1)
        path.value = open_values(path, log_p, keys, bound, rank, since, samples + 1)
        paths.append(path)
        results.append({"rank": rank, "there": there, "path": path, "log_p": path.log_p, "value": bound})

        # the best open branch of each text, over all of its segmentations so far
        tops = [best_of(p, docs) for p in paths]
        values = np.stack([t[0] for t in tops])
        parent = values.argmax(axis=0)
        best = values[parent, np.arange(docs)]
        results[-1]["open"] = best
        there = np.isfinite(best)
        if rank == samples - 1 or not there.any():
            break
        at = np.stack([t[1] for t in tops])[parent, np.arange(docs)]
        nodes, taken, prefix = np.zeros(docs, np.int64), np.zeros(docs, np.int64), np.zeros(docs)
        index = np.zeros(docs, np.int64)
        for q, p in enumerate(paths):
            mine = np.flatnonzero(there & (parent == q))
            a = at[mine]
            taken[mine], prefix[mine], index[mine] = p.edge[a], p.before[a], a - p.starts[mine]
            nodes[mine] = lat.nodes_of(p.edge[a])
        # which of the edges not taken yet continues: the greatest with noise, among the node's edges
        used = [taken] + [np.where((b["parent"] == parent) & (b["index"] == index), b["edge"], -1) for b in branches]
        chosen, top, left = np.full(docs, -1, np.int64), np.full(docs, -np.inf), np.zeros(docs)
        width = int((lat.at[nodes + 1] - lat.at[nodes])[there].max())
        for j in range(width):
            e = np.minimum(lat.at[nodes] + j, lat.at[nodes + 1] - 1)
            free = there & (lat.at[nodes] + j < lat.at[nodes + 1])
            for x in used:
                free &= e != x
            noise = np.where(free, log_p[e] + gumbel(uniform(keys, rank, 3, j)), -np.inf)
            left += np.where(free, np.exp(log_p[e]), 0.0)
            chosen, top = np.where(noise > top, e, chosen), np.maximum(noise, top)
        there &= chosen >= 0
        # what remains of the branch stays open, below the value just taken
        with np.errstate(divide="ignore", invalid="ignore"):
            remains = prefix + np.log(np.maximum(left - np.exp(log_p[chosen]), 0.0))
        again = below(np.where(left - np.exp(log_p[chosen]) > 1e-12, remains, -np.inf), best, uniform(keys, rank, 4))
        for q, p in enumerate(paths):
            mine = np.flatnonzero((parent == q) & np.isfinite(best))
            p.value[at[mine]] = np.where(there[mine], again[mine], -np.inf)
        branches.append({"parent": parent, "index": index, "edge": chosen})

        # the way up to the branch, the edge, the rest of its word, and all later words anew
        go = np.flatnonzero(there)
        parts_word, parts_edge = [], []
        branch_word = np.zeros(docs, np.int64)
        for q, p in enumerate(paths):
            mine = there & (parent == q)
            keep = mine[p.doc] & (np.arange(len(p.edge)) < (p.starts + index)[p.doc])
            parts_word.append(p.word[keep])
            parts_edge.append(p.edge[keep])
            sel = np.flatnonzero(mine)
            branch_word[sel] = p.word[p.starts[sel] + index[sel]]
        parts_word.append(branch_word[go])
        parts_edge.append(chosen[go])
        later = np.flatnonzero(there[batch.doc] & (word > branch_word[batch.doc]))
        words = np.concatenate([branch_word[go], later])
        begin = np.concatenate([lat.end[chosen[go]], lat.first[batch.kind[later]]])
        which, edge = batch.walk(words, begin, keys, rank + 1)
        source = np.concatenate([np.full(len(x), k) for k, x in enumerate([*parts_word, which])])
        all_word = np.concatenate([*parts_word, words[which] if len(which) else empty])
        all_edge = np.concatenate([*parts_edge, edge])
        order = np.lexsort((np.arange(len(all_word)), source, all_word))
        all_word, all_edge = all_word[order], all_edge[order]
        path = Path(docs, all_word, all_edge, batch.doc[all_word], log_p)
        bound = np.where(there, best, -np.inf)
    return results


class Written:
    """Pieces of edges as ids, and ids as bytes."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.sizes = np.array([len(r) for r in pieces.raw], np.int64)
        self.flat = np.frombuffer(b"".join(pieces.raw), np.uint8)
        self.first = np.cumsum(self.sizes) - self.sizes

    def ids(self, lat: Known, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the edges' pieces, and how many each edge has; a character without a piece is its bytes."""
        piece = lat.piece[edges]
        odd = np.flatnonzero(piece < 0)
        if not len(odd):
            return piece, np.ones(len(edges), np.int64)
        raw = [chr(c).encode() for c in lat.chars[lat.char[edges[odd]]]]
        counts = np.ones(len(edges), np.int64)
        counts[odd] = [len(r) for r in raw]
        out = np.repeat(piece, counts)
        out[np.repeat(piece < 0, counts)] = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64) + self.pieces.bytes_first
        return out, counts

    def decoded(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of some ids, `counts` for each: pieces one after the other, `▁` as space, without the first one."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        raw = self.flat[np.repeat(self.first[ids] - (ends - sizes), sizes) + np.arange(total)].tobytes()
        at = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)].tolist()
        return [raw[s:e].decode("utf-8", "replace").replace(SPACE, " ")[1:] for s, e in zip(at[:-1], at[1:], strict=True)]


def sample_texts(keys: np.ndarray, texts: list[str], pieces: Pieces, written: Written, samples: int) -> pd.DataFrame:
    """All results for some texts: place of the text, rank, ids as bytes, n_pieces, log_prob, log_inclusion, decodes."""
    batch = Batch(texts, pieces)
    results = search(batch, keys, samples)
    last = results[-1]["open"]
    frames = []
    for r in results:
        path, docs = r["path"], np.flatnonzero(r["there"])
        ids, counts = written.ids(batch.lattices, path.edge) if batch.lattices else (np.empty(0, np.int64), np.empty(0, np.int64))
        per_doc = np.bincount(path.doc, counts, len(texts)).astype(np.int64)
        ends = np.cumsum(per_doc)
        texts_back = written.decoded(ids, per_doc)
        with np.errstate(divide="ignore", over="ignore"):
            reach = r["log_p"] - last
            score = np.where(np.isneginf(last), 0.0, np.where(reach < -30, reach, np.log(-np.expm1(-np.exp(np.minimum(reach, 50.0))))))
        cells = [ids[ends[d] - per_doc[d] : ends[d]] for d in docs]
        frames.append(pd.DataFrame({
            "at": docs, "rank": r["rank"], "n_pieces": per_doc[docs], "ids": [c.astype("<u2").tobytes() for c in cells], "log_prob": r["log_p"][docs],
            "log_inclusion": score[docs], "decodes": [texts_back[d] == texts[d].replace(SPACE, " ") for d in docs],
        }))
    return pd.concat(frames)


def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in stretches of some `BATCH_CHARS` of text, one row at least; nothing is copied."""
    for b in batches:
        part = np.cumsum(pc.utf8_length(b["text"]).to_numpy().astype(np.int64)) // BATCH_CHARS
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(part)], strict=False):
            yield b.slice(s, e - s)


def segmentations(documents: DataFrame, vocabulary: str, samples: int = 2, alpha: float = 0.2, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document and rank: doc_id, rank, n_pieces, ids (little-endian 16-bit), ids_crc32, log_prob, log_inclusion, decodes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(vocabulary, alpha)
        written = Written(pieces)
        for some in stretches(batches):
            ids = some["doc"].to_numpy()
            keys = mixed((ids.view(np.uint64) + np.uint64(seed) * SALTS[1]) * SALTS[2])
            out = sample_texts(keys, some["text"].to_pylist(), pieces, written, samples)
            out.insert(0, "doc_id", ids[out["at"].to_numpy()])
            out["ids_crc32"] = [zlib.crc32(x) for x in out["ids"]]
            yield pa.RecordBatch.from_pandas(out[RESULT.names], RESULT, preserve_index=False)

    docs = documents.select(known_key(F.col(id_col)).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    out = docs.mapInArrow(rows, "doc_id bigint, rank int, n_pieces bigint, ids binary, ids_crc32 bigint, log_prob double, log_inclusion double, decodes boolean")
    return out.withColumn("doc_id", real_key(F.col("doc_id")))


def decode(ids: bytes, vocabulary: str) -> str:
    """The text of one result's ids."""
    known = np.frombuffer(ids, "<u2").astype(np.int64)
    return Written(pieces_of(vocabulary, 1.0)).decoded(known, np.array([len(known)]))[0]

"""An interpolated modified Kneser-Ney trigram model, counted in Spark, kept as sorted hash arrays and mapped by workers.

Documents are coded once into chunks (see `chunks`): the hashes of a chunk's distinct words, and their numbers in text order.
These are files in the shared folder, read by whoever settles a chunk, so shuffles carry questions and answers only. Each job's
shuffle files go when it ends.
Training asks three times. Chunks tell how often each of their distinct trigrams comes and learn how often it comes in
all; one chunk owns each trigram. Owned trigrams tell, per bigram, how many words precede it and what follows it; owned
bigrams tell the same of words. A bucket of hashes stores what it counted in the model's folder: sorted hashes and an array
for each count beside them, or the hash alone where an n-gram was seen once. Common words cost one entry per chunk, whatever follows them.

To score, chunks ask for the n-grams of all orders at once. The worker that has a bucket's questions maps that
bucket's arrays into memory and looks the sorted hashes up in them, so a worker touches one part of the model, not all of it.
Chunks are scored in `WAVES` jobs, so that few questions lie on disk at a time.

    p(w | u v) = (c(u v w) - D3(c(u v w))) / c(u v .) + g(u v) p(w | v)
    p(w | v)   = (n(. v w) - D2(n(. v w))) / n(. v .) + g(v) p(w)
    p(w)       = (n(. w) - D1(n(. w))) / n(. .) + g / (V + 1)

with discounts D for counts of 1, 2 and more from the counts of counts (Chen and Goodman), n(. x) the number of different
words before x, and the last term shared by all words and the unknown one. Texts begin with two marks that are no tokens
and end with one that is.

Words are told apart by hashes of 64 bits, longer n-grams by the 47 to 48 bits that a hash has within its bucket (64 in all from
65,536 buckets on): of some 2 million in a bucket an unseen one is taken for a known one with chance 1.5e-8, whatever the size of
the corpus. The folder must be one that all workers can open as files (`file:` or a plain path).

Edge cases: NULL or empty text is the end token alone. A document with NULL id trains. Without training documents every
token has probability 1 / (V + 1) = 1. Repeated rows train and are scored each. A text is in one chunk however long it is.
An empty table gives no rows. Only the id and text columns are read, so other columns' names don't matter.
"""

from __future__ import annotations

import os
import pickle
import uuid
import zlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial, reduce
from urllib.parse import unquote, urlparse

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.chunks import ANSWERS, Asked, answered, ask, bucket_count, chunk_table, pack, questions, settle, sums, unpack
from lakeops.llm.hashing import factors, mixed
from lakeops.llm.ranges import LEAST, real_key
from lakeops.session import materialize, scratch_path, without_shuffles

START, END = (np.uint64(x) for x in factors(2, 8))
PAIR, TRIPLE = factors(2, 2), factors(3, 3)
QUESTIONS = "bucket bigint, chunk bigint, cell binary"
TOLD = "chunk bigint, bucket bigint, cell binary, told array<bigint>"
TOTALS = -1  # stands for the chunk in rows that tell a bucket's totals
ORDER = 1 << 40  # buckets of order k are numbered from k times this on, where all orders are asked at once
#: Jobs in which chunks are scored, and tasks that settle chunks at most.
WAVES, MOST_TASKS = 4, 2000
#: Bytes of a hash within its bucket, for n-grams of more than one word.
PLACE_BYTES = 6
#: Counts of an n-gram seen once, by order: words have their count, and those below the highest what precedes and follows them.
ONCE = {1: (1, 1, 1, 1, 0, 0), 2: (1, 1, 1, 0, 0), 3: (1,)}


def held_out(doc_id: int, parts: int, part: int) -> bool:
    return doc_id != LEAST and zlib.crc32(str(doc_id).encode()) % parts == part


class Found:
    """Distinct hashes in order."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes

    def sums(self, which: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(which, weights, len(self.hashes)).astype(np.int64)


class Distinct(Found):
    """Distinct hashes in order, for each entry its place among them, and an entry of each."""

    def __init__(self, hashes: np.ndarray):
        order = np.argsort(hashes)
        ordered = hashes[order]
        starts = np.ones(len(ordered), bool)
        starts[1:] = ordered[1:] != ordered[:-1]
        super().__init__(ordered[starts])
        self.entry = order[starts]
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(starts) - 1


def coded_body(ids: np.ndarray, texts: list[bytes]) -> tuple:
    """What `Coded` reads: the hashes of the distinct tokens, and each text as numbers of these, the end included."""
    lists = [t.lower().split() for t in texts]
    counts = np.array([len(x) + 1 for x in lists], np.int64)
    flat = np.empty(int(counts.sum()) - len(lists), dtype=object)
    flat[:] = [w for x in lists for w in x]
    codes, words = pd.factorize(flat)
    known = pd.util.hash_array(words, categorize=False) if len(words) else np.empty(0, np.uint64)
    numbers = np.zeros(int(counts.sum()), np.uint32)
    inner = np.ones(len(numbers), bool)
    inner[np.cumsum(counts) - 1] = False
    numbers[inner] = codes + 1
    return ids.tobytes(), counts.tobytes(), np.concatenate([[END], known]).astype(np.uint64).tobytes(), pack(numbers)


def coded_file(folder: str, ids: np.ndarray, texts: list[bytes]) -> tuple:
    """What `Coded` reads, in a file of the folder; the body is its path."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"{uuid.uuid4().hex}.chunk")
    with open(path, "wb") as f:
        f.write(zstandard.ZstdCompressor(level=1).compress(pickle.dumps(coded_body(ids, texts), 5)))
    return (path,)


def unpacked(body: bytes) -> tuple:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(body))


class Coded:
    def __init__(self, body: bytes):
        parts = unpacked(body)
        if len(parts) == 1:
            with open(parts[0], "rb") as f:
                parts = unpacked(f.read())
        ids, counts, known, numbers = parts
        self.ids, self.counts = np.frombuffer(ids, np.int64), np.frombuffer(counts, np.int64)
        self.known, self.codes = np.frombuffer(known, np.uint64), unpack(numbers)[0]


def finer_than(buckets: int) -> np.uint64:
    """Low bits that hashes of longer n-grams are without, so that within a bucket `PLACE_BYTES` hold them."""
    return np.uint64(max(0, 64 - 8 * PLACE_BYTES - (buckets.bit_length() - 1)))


class Tokens:
    """Tokens of a chunk, the one before each and the one before that; of all documents or of those marked."""

    def __init__(self, chunk: Coded, buckets: int, marked: np.ndarray | None = None):
        here = np.repeat(marked, chunk.counts) if marked is not None else slice(None)
        self.counts = chunk.counts if marked is None else chunk.counts[marked]
        self.starts = np.cumsum(self.counts) - self.counts
        self.known, self.fine = np.append(chunk.known, START), finer_than(buckets)
        self.tokens = chunk.codes[here].astype(np.int64)
        self.before = self.shifted(self.tokens, len(self.known) - 1)
        self.earlier = self.shifted(self.before, len(self.known) - 1)

    def shifted(self, tokens: np.ndarray, first: int) -> np.ndarray:
        out = np.empty_like(tokens)
        out[1:] = tokens[:-1]
        out[self.starts] = first
        return out

    def hashed(self, by: np.ndarray, *tokens: np.ndarray) -> np.ndarray:
        parts = [(self.known * x)[t] for x, t in zip(by, tokens, strict=True)]
        return mixed(sum(parts[1:], parts[0])) >> self.fine << self.fine

    def trigrams(self) -> Distinct:
        return Distinct(self.hashed(TRIPLE, self.earlier, self.before, self.tokens))

    def bigrams(self) -> tuple[Distinct, np.ndarray, np.ndarray]:
        """All bigrams, and for each token the place of the one that it ends and of the one before it, which the token
        before it ends; the pair of marks is the last entry."""
        marks = np.full(min(len(self.tokens), 1), len(self.known) - 1)
        found = Distinct(self.hashed(PAIR, np.append(self.before, marks), np.append(self.tokens, marks)))
        ending = found.which[: len(self.tokens)]
        return found, ending, self.shifted(ending, found.which[-1] if len(marks) else 0)

    def words(self) -> tuple[Found, np.ndarray, np.ndarray]:
        """All words, and for each token its own place and that of the word before it."""
        hashes, place = np.unique(self.known, return_inverse=True)
        own, before = place[self.tokens], place[self.before]
        there = np.zeros(len(hashes), bool)
        there[own] = there[before] = True
        place = np.cumsum(there) - 1
        return Found(hashes[there]), place[own], place[before]


def followers(found: Found, context: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """What follows each context: how often in all, and how many of count 1, 2 and more."""
    return [found.sums(context, counts), *[found.sums(context, hit) for hit in (counts == 1, counts == 2, counts > 2)]]


def counts_of_counts(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


@dataclass(frozen=True)
class Discounts:
    """What counts of 1, 2 and more give away."""

    one: float
    two: float
    more: float

    @classmethod
    def of(cls, n1: int, n2: int, n3: int, n4: int) -> Discounts:
        if not n1 or not n2:
            return cls(0.5, 0.75, 1.0)
        y = n1 / (n1 + 2 * n2)
        more = 3 - 4 * y * n4 / n3 if n3 else 1.0
        return cls(min(max(1 - 2 * y * n2 / n1, 0.1), 1.0), min(max(2 - 3 * y * n3 / n2, 0.1), 2.0), min(max(more, 0.1), 3.0))

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts >= 3, self.more, np.where(counts == 2, self.two, np.where(counts == 1, self.one, 0.0)))

    def given(self, n1: np.ndarray, n2: np.ndarray, n3: np.ndarray) -> np.ndarray:
        return self.one * n1 + self.two * n2 + self.more * n3

    def interpolated(self, counts: np.ndarray, context: np.ndarray, kinds: list[np.ndarray], lower: np.ndarray) -> np.ndarray:
        """The counts discounted, and what that gives away dealt out by the order below; all of it after unseen contexts."""
        seen = np.maximum(context, 1)
        return np.maximum(counts - self(counts), 0) / seen + np.where(context > 0, self.given(*kinds) / seen, 1.0) * lower


@dataclass(frozen=True)
class Model:
    """A stored model: its folder, its number of buckets, what all words share."""

    folder: str
    buckets: int
    files: int
    discounts: tuple[Discounts, Discounts, Discounts]
    once: tuple[int, int, int]
    pairs: int
    tokens: int
    vocabulary: int

    def path(self, order: int, bucket: int) -> str:
        return array_path(self.folder, order, bucket)

    def check(self) -> None:
        found = sum(name.endswith(".npy") for name in os.listdir(self.folder)) if self.files else 0
        if found != self.files:
            raise FileNotFoundError(f"{found} of {self.files} files of the model in {self.folder}")


def array_path(folder: str, order: int, bucket: int) -> str:
    return os.path.join(folder, f"{order}-{bucket}.npy")


def narrow(order: int, bucket: int, buckets: int, hashes: np.ndarray) -> np.ndarray:
    """Sorted hashes as they are stored: of longer n-grams, what they have within their bucket, as bytes that sort alike."""
    if order == 1:
        return hashes
    inside = (hashes - np.uint64((bucket << 64) // buckets)) >> finer_than(buckets)
    return np.ascontiguousarray(inside.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - PLACE_BYTES :]).view(f"S{PLACE_BYTES}").reshape(-1)


def widened(order: int, bucket: int, buckets: int, stored: np.ndarray) -> np.ndarray:
    if order == 1:
        return stored
    raw = np.ascontiguousarray(stored).view(np.uint8).reshape(-1, PLACE_BYTES)
    whole = np.zeros((len(raw), 8), np.uint8)
    whole[:, 8 - PLACE_BYTES :] = raw
    inside = whole.view(">u8").reshape(-1).astype(np.uint64)
    fine, base = finer_than(buckets), np.uint64((bucket << 64) // buckets)
    # the bucket may begin between two values that a hash can have
    return ((inside << fine) + base + ((np.uint64(1) << fine) - np.uint64(1))) >> fine << fine


def store(folder: str, order: int, bucket: int, buckets: int, hashes: np.ndarray, counts: list[np.ndarray]) -> None:
    """One file: the sorted hashes of n-grams seen once, which need no counts, then those of all others, and an array for
    each of their counts, as wide as they need. It appears whole, also if a task runs twice."""
    table = np.stack(counts)
    single = (table.T == ONCE[order]).all(axis=1)
    rest = table[:, ~single]
    once, others = (narrow(order, bucket, buckets, x) for x in (hashes[single], hashes[~single]))
    widths = [np.min_scalar_type(int(x.max(initial=0))) for x in rest]
    kinds = np.dtype([(f"c{k}", w, (rest.shape[1],)) for k, w in enumerate(widths)]) if len(rest) > 1 else (widths[0], (1, rest.shape[1]))
    whole = np.empty(1, [("once", once.dtype, (len(once),)), ("hash", others.dtype, (len(others),)), ("counts", *kinds) if isinstance(kinds, tuple) else ("counts", kinds)])
    whole["once"][0], whole["hash"][0] = once, others
    for k, x in enumerate(rest):
        stored_count(whole, k)[:] = x
    os.makedirs(folder, exist_ok=True)
    part = os.path.join(folder, f"{order}-{bucket}-{uuid.uuid4().hex}.part")
    with open(part, "wb") as f:
        np.save(f, whole)
    os.replace(part, array_path(folder, order, bucket))


def stored_count(stored: np.ndarray, k: int) -> np.ndarray:
    """The k-th count of the n-grams that have counts."""
    counts = stored["counts"]
    return counts[f"c{k}"][0] if counts.dtype.names else counts[0][k]


def places(known: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which hashes are in the sorted array, and where those are."""
    if not len(known):
        return np.zeros(len(hashes), bool), np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    hit = known[at] == hashes
    return hit, at[hit]


def looked_up(path: str, order: int, bucket: int, buckets: int, hashes: list[np.ndarray]) -> list[list[np.ndarray]]:
    """For each array of sorted hashes, the counts of each hash in the file, which is mapped; 0 for those not in it."""
    stored = np.load(path, mmap_mode="r") if os.path.exists(path) else None
    if stored is not None:
        once, others = (widened(order, bucket, buckets, stored[k][0]) for k in ("once", "hash"))
    out = []
    for h in hashes:
        counts = np.zeros((len(ONCE[order]), len(h)), np.int64)
        if stored is not None:
            hit, _ = places(once, h)
            counts[:, hit] = np.array(ONCE[order])[:, None]
            hit, at = places(others, h)
            for k, row in enumerate(counts):
                row[hit] = stored_count(stored, k)[at]
        out.append(list(counts))
    return out


def local_folder(path: str) -> str:
    parsed = urlparse(path)
    if parsed.scheme not in ("", "file"):
        raise ValueError(f"workers can't map files in {path}; name a folder that all of them mount")
    return unquote(parsed.path) if parsed.scheme else path


def settling(chunks: DataFrame) -> int:
    """A task for each chunk, as the rows by which chunks are dealt out are small whatever their work is."""
    return min(max(chunks.count(), 1), MOST_TASKS)


def counted(asked: DataFrame, count: Callable[[Asked], pd.DataFrame], name: str) -> tuple[DataFrame, list[int], int]:
    """The buckets' answers, the sum of their totals, and how many buckets there were."""
    with without_shuffles(asked.sparkSession):
        rows = materialize(asked.groupBy("bucket").applyInPandas(lambda group: count(Asked(group)), TOLD), name)
    totals = rows.where(F.col("chunk") == TOTALS)
    found = totals.select("bucket", F.posexplode("told")).groupBy("pos").agg(F.sum("col").alias("n"), F.count("*").alias("buckets")).orderBy("pos").collect()
    return rows.where(F.col("chunk") != TOTALS).drop("told"), [r["n"] for r in found] or [0] * 8, found[0]["buckets"] if found else 0


def told_rows(bucket: int, told: list[int], answers: pd.DataFrame | None = None) -> pd.DataFrame:
    own = pd.DataFrame({"chunk": [TOTALS], "bucket": [bucket], "cell": [b""], "told": [told]})
    return own if answers is None else pd.concat([answers.assign(told=None), own])


def train(chunks: DataFrame, trains: Callable[[np.ndarray], np.ndarray], folder: str | None = None) -> Model:
    """The model of the documents that `trains` marks among a chunk's ids, stored in `folder` (a new one in the shared
    scratch folder if none is named)."""
    folder = local_folder(folder or scratch_path(chunks.sparkSession, "ngram-model"))
    buckets, tasks = bucket_count(chunks), settling(chunks)

    def tokens(chunk: Coded) -> Tokens:
        return Tokens(chunk, buckets, trains(chunk.ids))

    def ask_trigrams(number: int, chunk: Coded) -> pd.DataFrame:
        found = tokens(chunk).trigrams()
        return questions(number, found.hashes, (found.sums(found.which),), buckets)

    def owned(asked: Asked) -> np.ndarray:
        out = np.zeros(len(asked.which), bool)
        out[asked.order[asked.at]] = True
        return out

    def count_trigrams(asked: Asked) -> pd.DataFrame:
        c = asked.gather(np.add, asked.more[0])
        store(folder, 3, asked.bucket, buckets, asked.hashes, [c])
        return told_rows(asked.bucket, counts_of_counts(c), asked.answers(c[asked.which], owned(asked)))

    def ask_bigrams(number: int, chunk: Coded, cells: pd.DataFrame) -> pd.DataFrame:
        if not len(cells):
            return pd.DataFrame([], columns=["bucket", "chunk", "cell"])
        t = tokens(chunk)
        trigrams = t.trigrams()
        count, mine = answered(cells)
        entry, count = trigrams.entry[mine], count[mine]
        found, ending, context = t.bigrams()
        return questions(number, found.hashes, (found.sums(ending[entry]), *followers(found, context[entry], count)), buckets)

    def count_bigrams(asked: Asked) -> pd.DataFrame:
        counts = [asked.gather(np.add, x) for x in asked.more]
        store(folder, 2, asked.bucket, buckets, asked.hashes, counts)
        return told_rows(asked.bucket, counts_of_counts(counts[0]), asked.answers(counts[0][asked.which], owned(asked)))

    def ask_words(number: int, chunk: Coded, cells: pd.DataFrame) -> pd.DataFrame:
        if not len(cells):
            return pd.DataFrame([], columns=["bucket", "chunk", "cell"])
        t = tokens(chunk)
        bigrams, _, _ = t.bigrams()
        count, mine = answered(cells)
        mine &= count > 0  # leaves the pair of marks out, which ends no trigram; all others end at some token of the chunk
        entry, count = bigrams.entry[mine], count[mine]
        found, own, before = t.words()
        return questions(number, found.hashes, (found.sums(own), found.sums(own[entry]), *followers(found, before[entry], count)), buckets)

    def count_words(asked: Asked) -> pd.DataFrame:
        counts = [asked.gather(np.add, x) for x in asked.more]
        store(folder, 1, asked.bucket, buckets, asked.hashes, counts)
        c, preceded = counts[:2]
        return told_rows(asked.bucket, [*counts_of_counts(preceded), int((preceded > 2).sum()), int(preceded.sum()), int(c.sum()), int((c > 0).sum())])

    trigrams, n3, files3 = counted(ask(chunks, ask_trigrams, Coded), count_trigrams, "trigram-counts")
    bigrams, n2, files2 = counted(settle(chunks, trigrams, ask_bigrams, QUESTIONS, Coded, tasks), count_bigrams, "bigram-counts")
    _, n1, files1 = counted(settle(chunks, bigrams, ask_words, QUESTIONS, Coded, tasks), count_words, "word-counts")
    discounts = tuple(Discounts.of(*n[:4]) for n in (n1, n2, n3))
    return Model(folder, buckets, files1 + files2 + files3, discounts, (n1[0], n1[1], n1[4]), *n1[5:8])


def score_chunks(chunks: DataFrame, model: Model, out_of: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Every document of the chunks by a stored model; `out_of` says which ids are held out. Scores are written when this is called."""
    model.check()
    spark, tasks = chunks.sparkSession, settling(chunks)

    def ask_all(number: int, chunk: Coded) -> pd.DataFrame:
        t = Tokens(chunk, model.buckets)
        asked = {3: t.trigrams().hashes, 2: t.bigrams()[0].hashes, 1: t.words()[0].hashes}
        rows = [questions(number, hashes, (), model.buckets) for hashes in asked.values()]
        return pd.concat([r.assign(bucket=r["bucket"].astype("int64") + k * ORDER) for k, r in zip(asked, rows, strict=True)])

    def look_up(group: pd.DataFrame) -> pd.DataFrame:
        order, bucket = divmod(int(group["bucket"].iloc[0]), ORDER)
        found = looked_up(model.path(order, bucket), order, bucket, model.buckets, [sums(unpack(c)[0]) for c in group["cell"]])
        return pd.DataFrame({"chunk": group["chunk"], "bucket": group["bucket"], "cell": [pack(*x) for x in found]})

    def score(number: int, chunk: Coded, cells: pd.DataFrame) -> pd.DataFrame:
        t = Tokens(chunk, model.buckets)
        of = lambda k: answered(cells[cells["bucket"] // ORDER == k])
        low, mid, high = model.discounts
        _, own, before = t.words()
        count, preceded, *follow = of(1)
        base = np.log10((count + 1) / (model.tokens + model.vocabulary + 1))
        if model.pairs:
            rest = low.given(*model.once) / model.pairs / (model.vocabulary + 1)
            alone = np.maximum(preceded - low(preceded), 0) / model.pairs + rest
        else:
            alone = np.full(len(count), 1 / (model.vocabulary + 1))
        _, ending, context = t.bigrams()
        after, *pair_follow = of(2)
        at = lambda arrays, places: [x[places] for x in arrays]
        n, *kinds = at(follow, before)
        p = mid.interpolated(after[ending], n, kinds, alone[own])
        n, *kinds = at(pair_follow, context)
        p = high.interpolated(of(3)[0][t.trigrams().which], n, kinds, p)
        per_doc = lambda x: np.add.reduceat(x, t.starts)
        return pd.DataFrame({
            "doc_id": chunk.ids, "held_out": out_of(chunk.ids), "n_tokens": t.counts, "n_known": per_doc((count[own] > 0).astype(np.int64)),
            "train_tokens": model.tokens, "base_score": per_doc(base[own]), "score": per_doc(np.log10(p)),
        })

    def scored(some: DataFrame) -> DataFrame:
        answers = ask(some, ask_all, Coded, QUESTIONS).groupBy("bucket").applyInPandas(look_up, ANSWERS.replace("bucket int", "bucket bigint"))
        return settle(some, answers, score, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double", Coded, -(-tasks // WAVES))

    # chunks of one split have numbers in a row, and splits are 2^32 apart
    wave = (F.shiftright("chunk", 32) + F.col("chunk").bitwiseAND((1 << 32) - 1)) % WAVES
    with without_shuffles(spark):
        parts = [materialize(scored(chunks.where(wave == k)), "scores") for k in range(WAVES)]
    return reduce(DataFrame.unionByName, parts).withColumn("doc_id", real_key(F.col("doc_id")))


def held_out_ids(parts: int, part: int, ids: np.ndarray) -> np.ndarray:
    return np.array([held_out(int(i), parts, part) for i in ids], bool)


def scores(documents: DataFrame, parts: int = 7, part: int = 2, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Documents train unless crc32 of the id as text leaves `part` modulo `parts`. The model is counted and stored when this
    is called, and the scores are written.
    """
    texts = local_folder(scratch_path(documents.sparkSession, "ngram-chunks"))
    chunks = chunk_table(documents, id_col, text_col, body_of=partial(coded_file, texts))
    out_of = partial(held_out_ids, parts, part)
    return score_chunks(chunks, train(chunks, lambda ids: ~out_of(ids), folder), out_of)


def perplexity(scored: DataFrame) -> DataFrame:
    """Perplexity per token over held-out and training documents, by the model and by single words."""
    per = lambda name: F.pow(F.lit(10.0), -F.sum(name) / F.sum("n_tokens"))
    return scored.groupBy("held_out").agg(per("score").alias("perplexity"), per("base_score").alias("base_perplexity"), F.sum("n_tokens").alias("n_tokens"))

"""I-Match fingerprints: hashes of a document's distinct terms that lie in a band of document frequency.

Document frequencies are counted over all documents (partitions send sorted distinct hashes with counts to buckets, see
`chunks`). The lexicon holds the terms found in a share of `least` to `most` of the documents; as no document counts a term
twice, it has at most (mean distinct terms of a document) / `least` terms, whatever the size of the corpus, so it may be sent to
all tasks. Beside the whole lexicon, randomised subsets are taken that keep a term with probability 1/2 to 1/4096. The
document's distinct terms are sorted and the hashes of those in a subset are summed up to the subset's mark. Equal texts
agree in all subsets; two texts agree in a subset if they differ in none of its terms, so small subsets still agree after
many edits: where a subset keeps about one term of a text, the chance to agree is the share of terms in common.

The likeness of two fingerprints is the share of subsets in which they agree, of small subsets where either has a term.

Edge cases: a text with words but none of the lexicon is fingerprinted by all its terms. NULL and empty texts have the empty
fingerprint; two empty ones are alike (1.0). NULL ids come first; documents of one id are ordered by hash of their text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.chunks import Asked, questions
from lakeops.llm.hashing import Words, factors, mixed
from lakeops.llm.ranges import known_key, range_bounds, range_of, real_key

#: Families of nested subsets of the lexicon; in each, level k keeps a term with probability 2 ** -k. Level 0 is the whole.
FAMILIES, LEVELS = 32, 12
SEEDS = factors(2 * FAMILIES, 4)
BATCH_BYTES = 2 << 20


def distinct_terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(document, term hash) of the distinct terms of each text, sorted."""
    words = Words(texts, lower=True)
    doc, h = words.text_of(), words.hashes
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    first = np.ones(len(h), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return doc[first], h[first]


def document_frequencies(documents: DataFrame, text_col: str, buckets: int) -> DataFrame:
    """(term, n): in how many documents each term is found."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            _, terms = distinct_terms([t.encode() for t in b["text"]])
            found, n = np.unique(terms, return_counts=True)
            yield questions(0, found, (n,), buckets)

    def total(group: pd.DataFrame) -> pd.DataFrame:
        asked = Asked(group)
        return pd.DataFrame({"term": asked.hashes.view(np.int64), "n": asked.gather(np.add, asked.more[0])})

    texts = documents.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.mapInPandas(count, "bucket int, chunk bigint, cell binary").groupBy("bucket").applyInPandas(total, "term bigint, n bigint")


def lexicon(documents: DataFrame, text_col: str = "text", least: float = 1e-3, most: float = 0.1) -> np.ndarray:
    """Sorted hashes of the terms in the band; their number has the bound told above."""
    n_docs = documents.count()
    buckets = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    band = document_frequencies(documents, text_col, buckets).where((F.col("n") >= least * n_docs) & (F.col("n") <= most * n_docs))
    rows = band.select("term").toPandas()
    return np.sort(rows["term"].to_numpy(np.int64).view(np.uint64))


def fingerprints(texts: list[bytes], terms: np.ndarray) -> np.ndarray:
    """One row per text: a 16-bit hash per subset, by level, then family; 0 where the text has no term of it."""
    doc, h = distinct_terms(texts)
    out = np.zeros((len(texts), (LEVELS + 1) * FAMILIES), np.uint16)
    if not len(h):
        return out
    place = np.minimum(np.searchsorted(terms, h), max(len(terms) - 1, 0))
    known = terms[place] == h if len(terms) else np.zeros(len(h), bool)
    some = np.zeros(len(texts), bool)
    some[doc[known]] = True
    used = known | ~some[doc]
    doc, h = doc[used], h[used]
    for k in range(FAMILIES):
        drawn = mixed(h * SEEDS[2 * k]) | np.uint64(1)
        level = np.minimum(63 - ((drawn.astype(np.float64).view(np.int64) >> 52) - 1023), LEVELS).clip(0)
        at = doc * (LEVELS + 1) + level
        totals = np.zeros(len(texts) * (LEVELS + 1), np.uint64)
        np.add.at(totals, at, mixed(h * SEEDS[2 * k + 1]))
        counts = np.bincount(at, minlength=len(totals))
        totals, counts = (x.reshape(len(texts), LEVELS + 1) for x in (totals, counts))
        # a term of level k is in the subsets of all levels up to k
        totals, counts = (np.cumsum(x[:, ::-1], axis=1, dtype=x.dtype)[:, ::-1] for x in (totals, counts))
        marks = np.where(counts > 0, (totals >> np.uint64(48)).astype(np.uint16) | np.uint16(1), 0)
        out[:, k::FAMILIES] = marks
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of subsets that agree, among those of the finest level that is not nearly empty, and all finer ones."""
    shape = (len(a), LEVELS + 1, FAMILIES)
    either = ((a != 0) | (b != 0)).reshape(shape).sum(axis=2)
    agree = ((a == b) & (a != 0)).reshape(shape).sum(axis=2)
    full = 4 * either >= 3 * FAMILIES
    level = np.where(full.any(axis=1), LEVELS - np.argmax(full[:, ::-1], axis=1), 0)
    used = np.arange(LEVELS + 1)[None, :] >= level[:, None]
    either, agree = (either * used).sum(axis=1), (agree * used).sum(axis=1)
    return np.where(either > 0, agree / np.maximum(either, 1), 1.0)


def printed(rows: np.ndarray) -> list[str]:
    return [r.astype(">u2").tobytes().hex() for r in rows]


def edited_text(text: str, following: str) -> str:
    """`text` with its last half replaced by as many first characters of `following`."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_edits(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 1e-3, most: float = 0.1) -> DataFrame:
    """Per document, in the order of ids: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Documents are dealt out in ranges of ids; the first document of each range also goes to the range before, to stand
    as the next of its last one. Texts are compressed for that.
    """
    spark = documents.sparkSession
    terms = spark.sparkContext.broadcast(lexicon(documents, text_col, least, most))
    docs = documents.select(known_key(F.col(id_col)).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = range_bounds(docs, "doc_id", ranges)
    reached = F.size(F.filter(F.array(*[F.lit(int(b)) for b in bounds]), lambda b: b <= F.col("doc_id"))) if len(bounds) else F.lit(0)
    heads = sorted((r["range"], r["head"]) for r in docs.select(reached.alias("range"), "doc_id").groupBy("range").agg(F.min("doc_id").alias("head")).collect())
    goes_to = {head: heads[k - 1][0] for k, (_, head) in enumerate(heads)}

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = zstandard.ZstdCompressor(level=1)
        for b in batches:
            raw = [t.encode() for t in b["text"]]
            made = pd.DataFrame({"range": range_of(b["doc_id"], bounds), "tail": False, "doc_id": b["doc_id"], "hash": [hashlib.blake2b(t, digest_size=8).digest() for t in raw], "packed": [packer.compress(t) for t in raw]})
            yield made
            copies = made[made["doc_id"].isin(list(goes_to))]
            if len(copies):
                yield copies.assign(range=copies["doc_id"].map(goes_to).astype(np.int32), tail=True)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, held, size = zstandard.ZstdDecompressor(), [], 0

        def rows(some: list) -> pd.DataFrame:
            """Of all but the last of `some`, which stands as the next of the one before."""
            texts = [t for _, t in some]
            edited = [edited_text(t, n) for t, n in zip(texts[:-1], texts[1:], strict=True)]
            raw = [t.encode() for t in edited]
            marks = fingerprints([t.encode() for t in texts] + raw, terms.value)
            own, following, after = marks[: len(texts) - 1], marks[1 : len(texts)], marks[len(texts) :]
            return pd.DataFrame({
                "doc_id": [i for i, _ in some[:-1]], "n_chars": [len(t) for t in texts[:-1]], "edited_sha256": [hashlib.sha256(t).hexdigest() for t in raw],
                "fingerprint": printed(own), "edited_fingerprint": printed(after), "near_edited": likeness(own, after), "near_next": likeness(own, following),
            })

        ended = False
        for b in batches:
            for tail, i, packed in zip(b["tail"], b["doc_id"], b["packed"], strict=True):
                if ended:
                    continue
                ended = bool(tail)
                text = reader.decompress(packed).decode() if packed else ""
                held.append((i, text))
                size += len(text)
                if ended or size > BATCH_BYTES:
                    if len(held) > 1:
                        yield rows(held)
                        held, size = held[-1:], len(text)

    dealt = docs.mapInPandas(deal, "range int, tail boolean, doc_id bigint, hash binary, packed binary")
    ordered = dealt.repartitionById(ranges, F.col("range")).sortWithinPartitions("tail", "doc_id", "hash")
    out = ordered.mapInPandas(compare, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return out.withColumn("doc_id", real_key(F.col("doc_id")))


def fingerprinted(documents: DataFrame, text_col: str = "text", least: float = 1e-3, most: float = 0.1) -> DataFrame:
    """`documents` with a column `fingerprint`."""
    terms = documents.sparkSession.sparkContext.broadcast(lexicon(documents, text_col, least, most))

    def marks(texts: pd.Series) -> pd.Series:
        return pd.Series(printed(fingerprints([(t or "").encode() for t in texts], terms.value)))

    return documents.withColumn("fingerprint", F.pandas_udf(marks, "string")(F.col(text_col)))


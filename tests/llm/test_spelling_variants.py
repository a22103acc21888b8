"""Near words, forms and roots against plain Python over all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from lakeops.llm import spelling_variants
from lakeops.llm.queries import QUERIES


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def expected(counts, least_length=5, least_n=3):
    """By all words with one code point left out: two words of one such key, at one place or as the word itself, may be near."""
    vocabulary = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_n}
    keyed = {}
    for w in vocabulary:
        for key in {w, *(w[:k] + w[k + 1 :] for k in range(len(w)))}:
            keyed.setdefault(key, set()).add(w)
    pairs = {w: {v for k in {w, *(w[:k] + w[k + 1 :] for k in range(len(w)))} for v in keyed[k] if near(w, v)} for w in vocabulary}
    best = {w: min(p, key=lambda v: (-vocabulary[v], v)) for w, p in pairs.items() if p}
    form = {w: v for w, v in best.items() if vocabulary[v] >= 2 * vocabulary[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted(((w, form.get(w), root(w), n, len(pairs[w]), vocabulary.get(form.get(w))) for w, n in vocabulary.items()), key=repr)


def dense(letters, length, n, seed):
    rng = random.Random(seed)
    words = {"".join(rng.choices(letters, k=rng.randrange(1, length))) for _ in range(n)}
    return {w: rng.choice([1, 2, 3, 4, 8, 16, 33]) for w in words}


@pytest.mark.parametrize("group_words", [1, 3, 40, 20_000])
@pytest.mark.parametrize("case", [dense("ab", 9, 400, 1), dense("abé", 7, 300, 2), {**dense("ab", 5, 60, 3), **{"pre" * 5 + w + "fix": n for w, n in dense("abc", 6, 150, 4).items()}}])
def test_all_pairs(spark, rows, case, group_words):
    frame = spark.createDataFrame(list(case.items()), "word string, n bigint")
    got = spelling_variants.variants(frame, least_length=1, least_n=1, group_words=group_words)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert rows(got) == expected(case, 1, 1)


def test_minimised_acceptor_and_long_words():
    words = sorted(["tip", "top", "tips", "tops", "stip", "stops"])
    acceptor = spelling_variants.Acceptor(words)
    assert acceptor.arcs[acceptor.start]["t"] != acceptor.start and len(acceptor.arcs) == 10
    long = "ab" * 4000
    both = sorted([long + "c", long + "d", "x" + long + "c"])
    got = {frozenset(p) for p in spelling_variants.Acceptor(both).near(1 << 30)}
    assert got == {frozenset((long + "c", long + "d")), frozenset((long + "c", "x" + long + "c"))}


def test_documents(spark, rows, frame, odd):
    texts = [*odd, (20, "Häuser HÄuser häusern Tigers tigers TIGERS tiger×s ÷ x1y2 " * 30, "a"), (21, "häuser" * 40_000, "a")]
    for change, damage in ((spelling_variants.plain, False), (spelling_variants.misspelt(5), True)):
        counts = Counter()
        for key, text, _ in texts:
            for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
                run = run.translate({c: c + 32 for c in range(65, 91)})
                h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
                if damage and h % 5 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                counts[run] += 1
        counts.pop("", None)
        found = spelling_variants.word_counts(frame(texts), change)
        assert rows(found) == sorted(counts.items(), key=repr)
        assert rows(spelling_variants.variants(found)) == expected(counts)
    assert spelling_variants.variants(spelling_variants.word_counts(frame([]))).count() == 0


def test_query(spark, rows):
    sf, counts = "/root/testdata/sf0.001", Counter()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{r['doc_id']}:{run}".encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    got = rows(QUERIES["op12_spelling_variants"](spark, sf))
    assert got == expected(counts) and any(r[1] != r[2] for r in got if r[1])

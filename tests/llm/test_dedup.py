import hashlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from compare import connect, difference

from lakeops.llm import line_dedup, lsh_forest, substring_dedup, suffix_dedup
from lakeops.llm.chunks import Asked, questions, unpack
from lakeops.llm.components import components
from lakeops.llm.queries import ORACLES, QUERIES
from lakeops.llm.suffix_arrays import common_prefixes, suffix_array

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op2_lsh_forest", "op9_line_dedup", "op10_substring_dedup"])
def test_query_agrees_with_sql(spark, name):
    assert difference(spark, connect(SF), SF, QUERIES[name], ORACLES[name])[0] is None


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def order(i):
    return -(1 << 63) if i is None else i


def kept_lines(rows, least=10):
    first = {}
    split = [(order(i), (t or "").split("\n")) for i, t in rows]
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    for i, lines in split:
        for x in map(key, lines):
            first[x] = min(i, first.get(x, i))
    return ["\n".join(x for x in lines if len(key(x)) < least or first[key(x)] == i) for i, lines in split]


def test_lines_of_odd_rows(frame, odd):
    rows = [(t[0], t[1]) for t in odd] + [(30, "A hot line here\nown 30"), (31, "  a HOT line here\t\nown 31"), (32, "a hot line here\na hot line here")]
    docs = frame(rows)
    out = line_dedup.deduped_documents(docs)
    assert out.columns == docs.columns
    got = sorted((order(r["doc_id"]), r["text"] or "") for r in out.collect())
    assert got == sorted((order(i), k) for (i, _), k in zip(rows, kept_lines(rows), strict=True))
    assert line_dedup.deduped_documents(frame([])).count() == 0


def test_runs_over_range_edges(spark, frame):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(k, "one line that all of them have\nown line %d is not in others" % k) for k in range(300)]
        out = line_dedup.deduped_documents(frame(rows)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum("all of them" in r["text"] for r in out) == 1
    assert all(("all of them" in r["text"]) == (r["doc_id"] == 0) for r in out)


def kept_words(rows, n=13):
    split = [(order(i), (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in split:
        for k in range(len(w) - n + 1):
            g = tuple(w[k : k + n])
            first[g] = min(i, first.get(g, i))
    out = []
    for i, w in split:
        gone = {k + j for k in range(len(w) - n + 1) if first[tuple(w[k : k + n])] < i for j in range(n)}
        out.append((i, len(w), len(gone), sha(b" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def test_words_of_odd_rows(frame, odd, words):
    passage = " ".join(words(60, 90))
    rows = [(t[0], t[1]) for t in odd] + [(40 + k, " ".join(words(20, 91 + k)) + " " + passage + " " + " ".join(words(k, 99))) for k in range(9)]
    rows += [(60, " ".join(["same"] * 40)), (61, " ".join(["same"] * 20)), (62, " ".join(words(13, 90))), (63, " ".join(words(12, 90)))]
    out = substring_dedup.repeated_words(frame(rows))
    got = sorted((order(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out.collect())
    assert got == sorted(kept_words(rows))
    assert substring_dedup.repeated_words(frame([])).count() == 0


def kept_bytes(rows, n):
    raw = [(order(i), (t or "").encode()) for i, t in rows]
    seen = defaultdict(int)
    for _, b in raw:
        for k in range(len(b) - n + 1):
            seen[b[k : k + n]] += 1
    out = []
    for i, b in raw:
        mask = np.zeros(len(b), bool)
        for k in range(len(b) - n + 1):
            if seen[b[k : k + n]] > 1:
                mask[k : k + n] = True
        spans = int((np.diff(mask.astype(int), prepend=0) == 1).sum())
        out.append((i, len(b), int(mask.sum()), spans, sha(bytes(x for x, m in zip(b, mask, strict=True) if not m))))
    return out


@pytest.mark.parametrize("n", [128, 400])
def test_bytes_of_odd_rows(frame, odd, words, n):
    passage = " ".join(words(120, 90))
    small = [(t[0], (t[1] or "")[:3000] if t[1] is not None else None) for t in odd]
    rows = small + [(40 + k, " ".join(words(20, 91 + k)) + " " + passage + " " + " ".join(words(40 + k, 80 + k))) for k in range(6)]
    rows += [(60, passage + " " + passage), (61, passage[: n - 1] + "?"), (62, "ab" * 900), (63, passage[:n]), (64, "x" * (n + 1))]
    out = suffix_dedup.removed_bytes(frame(rows), length=n, group_bytes=5000)
    got = sorted((order(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out.collect())
    assert got == sorted(kept_bytes(rows, n))
    assert suffix_dedup.removed_bytes(frame([]), length=n).count() == 0


def test_surroundings_of_a_hot_passage(frame, words):
    passage = " ".join(words(120, 90))
    rows = [(k, " ".join(words(30, 91 + k)) + " " + passage + " " + " ".join(words(30 + k % 7, 500 + k % 55))) for k in range(60)] + [(60, "ab" * 900), (61, None)]
    out = suffix_dedup.removed_bytes(frame(rows), length=128, group_bytes=2000)
    got = sorted((order(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out.collect())
    assert got == sorted(kept_bytes(rows, 128))


def test_no_bytes_of_a_hot_anchor_are_sent():
    ones = lambda n, kind: np.ones(n, kind)
    anchors = np.sort(np.array([1 << 40] * 100 + [2 << 40] * 3, np.uint64))
    told = pd.concat([questions(c, anchors, (np.arange(103, dtype=np.uint64) + np.uint64(1000 * c), ones(103, np.uint32), ~ones(103, bool)), 1) for c in (1, 2)])
    answers = suffix_dedup.stretch_answers(Asked(told), 50)
    for cell in answers["cell"]:
        _, asks, sends = unpack(cell)
        assert asks.tolist() == [True] * 100 + [False] * 3 and sends.tolist() == [False] * 100 + [True] * 3


def test_suffix_query_by_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in QUERIES["op6_suffix_dedup"](spark, SF).collect())
    assert got == sorted(kept_bytes(rows, 400))


def test_planted_passages_go_from_400_bytes_on(frame, words):
    """Passages of 51 to 120 words, each in two documents: those shorter than 400 bytes stay, as the contract's length says."""
    passages = [" ".join(words(n, 1000 + n)) for n in range(51, 121, 3)]
    rows = [(2 * k + i, " ".join(words(30, 2000 + 2 * k + i)) + " " + "ab"[i] + p + "cd"[i] + " " + " ".join(words(30, 3000 + 2 * k + i))) for k, p in enumerate(passages) for i in (0, 1)]
    out = suffix_dedup.removed_bytes(frame(rows), length=400)
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out.collect())
    assert got == sorted(kept_bytes(rows, 400))
    assert [r[2] for r in got] == [len(p) if len(p) >= 400 else 0 for p in passages for _ in (0, 1)]
    assert 0 < sum(len(p) < 400 for p in passages) < len(passages)


@pytest.mark.parametrize("text", [b"", b"a", b"aaaa", b"banana", b"mississippi", b"abcabcabcab" * 9, bytes(range(256)) * 2, b"ba" * 50 + b"b"])
def test_suffix_arrays(text):
    want = sorted(range(len(text)), key=lambda i: text[i:])
    got = suffix_array(text, len(text) + 1)
    assert got.tolist() == want
    if len(text) > 1:
        shared = [next((k for k in range(min(len(text) - a, len(text) - b)) if text[a + k] != text[b + k]), min(len(text) - a, len(text) - b)) for a, b in zip(want, want[1:], strict=False)]
        assert common_prefixes(text, got, 64).tolist() == [min(x, 64) for x in shared]


def groups_of(rows, shingle, percent):
    def sets(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[k : k + shingle]) for k in range(len(w) - shingle + 1)} if len(w) >= shingle else ({tuple(w)} if w else set())

    s = [(order(i), sets(t)) for i, t in rows]
    parent = {i: i for i, _ in s}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (i, a) in enumerate(s):
        for j, b in s[:x]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                p, q = top(i), top(j)
                parent[max(p, q)] = min(p, q)
    return {i: top(i) for i, _ in s}


@pytest.mark.parametrize(("shingle", "percent"), [(3, 85), (5, 80)])
def test_groups_of_odd_rows(frame, odd, words, shingle, percent):
    import random

    rng = random.Random(5)
    rows = [(t[0], t[1]) for t in odd]
    for g in range(12):
        base = words(150, 300 + g)
        for k in range(8):
            copy = list(base)
            for _ in range(rng.randrange(5)):
                copy[rng.randrange(150)] = f"new{rng.randrange(10**6)}"
            rows.append((100 + 20 * g + k, " ".join(copy)))
    chain = words(300, 999)
    rows += [(500 - k, " ".join(chain[4 * k : 4 * k + 200])) for k in range(12)]
    want = groups_of(rows, shingle, percent)
    out = lsh_forest.near_duplicates(frame(rows), shingle, percent).collect()
    assert {order(r["doc_id"]): order(r["component_id"]) for r in out} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)
    docs = frame(rows)
    unique = lsh_forest.unique_documents(docs, shingle, percent)
    assert unique.columns == docs.columns
    left = [r["text"] for r in unique.collect()]
    assert len(left) == len(set(zip(left, range(len(left)), strict=True)))
    one_per_row = groups_of([(k, t) for k, (_, t) in enumerate(rows)], shingle, percent)
    assert len(left) == len(set(one_per_row.values()))


def test_full_regions_bring_together_what_can_link(spark, words):
    # sets of one family, each beyond the similarity of all others, and pairs within it
    base = np.arange(1000, 1100)
    rng = np.random.default_rng(1)
    sets = []
    for _ in range(60):
        x = base.copy()
        x[rng.choice(100, 14, replace=False)] = rng.integers(0, 60, 14) + 10**6 * rng.integers(1, 4)
        sets.append(np.unique(x))
    sets += [np.append(x[:-3], [7_000_000 + k]) for k, x in enumerate(sets[:20])]
    rows = [(k, k, k % 3 > 0, np.sort(x).astype(np.int64).tobytes()) for k, x in enumerate(sets)]
    full = spark.createDataFrame([r[:3] for r in rows], "node bigint, component bigint, outside boolean")
    hashes = spark.createDataFrame([(r[0], r[3]) for r in rows], "node bigint, hashes binary")
    pairs = lsh_forest.prefix_pairs(full, hashes, 85)
    got = {(r["a"], r["b"]) for r in pairs.collect()}
    reach = lambda a, b: 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))
    want = {(a, b) for a in range(80) for b in range(a) if (rows[a][2] or rows[b][2]) and reach(a, b)}
    want = {(min(p), max(p)) for p in want}
    assert len(want) > 5 and want <= got and all(rows[a][2] or rows[b][2] for a, b in got)
    # no join that brings components together regardless of sizes and places
    joins = [x for x in pairs._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x]
    assert len(joins) == 2 and all("place" in x for x in joins)


def test_small_tables_come_in_few_files(spark):
    links = spark.range(1000).select((F.col("id") - F.col("id") % 2).alias("a"), F.col("id").alias("b")).repartition(300, "b")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "150")
    try:
        out = components(links)
        assert len(out.inputFiles()) <= 4 * spark.sparkContext.defaultParallelism
        assert sorted(tuple(r) for r in out.collect()) == [(k, k - k % 2) for k in range(1000)]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_texts_come_in_stretches(monkeypatch):
    monkeypatch.setattr(lsh_forest, "STRETCH_CHARS", 100)
    b = pd.DataFrame({"doc": range(50), "text": ["x" * (k * 37 % 90) for k in range(49)] + ["y" * 500]})
    some = list(lsh_forest.stretches(iter([b, b[:0], b[:1]])))
    assert pd.concat(some)["doc"].tolist() == [*range(50), 0]
    assert len(some) > 10 and max(len(t) for x in some for t in ["".join(x["text"][:-1])]) < 200


def test_links_in_full_regions(frame, words):
    """300 texts of one template, mostly at 0.75 to 0.8 of each other, and 40 pairs among them at 0.87; all share regions."""
    import random

    rng, base, rows = random.Random(8), words(400, 700), []

    def changed(text, places):
        copy = list(text)
        for at in places:
            copy[at] = f"own{rng.randrange(10**9)}"
        return copy

    for k in range(260):
        own = changed(base, rng.sample(range(2, 398, 3), 8))
        rows.append((k, " ".join(own)))
        if k < 40:
            rows.append((1000 + k, " ".join(changed(own, rng.sample(range(2, 398, 3), 9)))))
    want = groups_of(rows, 3, 85)
    assert 200 < len(set(want.values())) < 300
    got = {r["doc_id"]: r["component_id"] for r in lsh_forest.near_duplicates(frame(rows), 3, 85, shape=lsh_forest.Shape(trees=12, least_depth=1)).collect()}
    assert got == want


@pytest.mark.parametrize("percent", [50, 70, 80, 85, 95, 100])
def test_trees_follow_the_similarity(percent):
    shape = lsh_forest.Shape.reaching(percent)
    assert (1 - (percent / 100) ** shape.least_depth) ** shape.trees <= 1e-5
    assert shape.least_depth <= shape.deepest <= shape.values <= 200


def test_groups_of_nothing(frame):
    assert lsh_forest.near_duplicates(frame([])).count() == 0
    assert lsh_forest.unique_documents(frame([(1, None), (2, ""), (None, " ")])).count() == 3


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(200, 260)] + [(5, 5), (1, 2), (2, 1)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[k] == 100 for k in range(100, 141))
    assert all(got[k] == 7 for k in range(200, 260)) and got[2] == 1

import re
from collections import Counter

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from lakeops.llm import mixing, quality_rules
from lakeops.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(text):
    w = WORD.findall(text or "")
    grams = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_statistics_by_hand(frame, odd):
    texts = odd + [(20, "a b c a b c d"), (21, "a a a a a"), (22, "l m\nl m\n\n \nl m\nx")]
    out = frame(texts).select("text", quality_rules.statistics(F.col("text")).alias("s")).select("text", *[f"s.{n}" for n in NAMES])
    for r in out.collect():
        assert tuple(r[1:]) == counted(r["text"])


def test_rules_find_planted_junk(spark, frame, words):
    good = [(k, " ".join(words(80 + k, k))) for k in range(150)]
    bad = [(200 + k, " ".join(f"{w}##" for w in words(80 + k, 500 + k))) for k in range(100)]
    docs = frame(good + bad)
    labels = spark.createDataFrame([(k, int(k < 200)) for k, _ in good + bad if k % 3] + [(0, None), (None, 1)], "doc_id bigint, quality int")
    rules = quality_rules.learn(quality_rules.labelled_statistics(docs, labels, "doc_id", "text", 1000))
    assert rules
    kept = quality_rules.kept_documents(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {k for k, _ in good}


def test_rules_without_labels(spark, frame, odd):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    kept = quality_rules.kept_documents(frame(odd), labels)
    want = [t[1] for t in odd if (c := counted(t[1]))[0] >= 50 and 100 * c[4] <= 50 * c[0]]
    assert sorted(r["text"] for r in kept.collect()) == sorted(want)
    assert quality_rules.kept_documents(frame([]), labels).count() == 0


def test_query_agrees_with_counts(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op1_quality_rules"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        got, want = rows[r["doc_id"]], counted(r["text"])
        assert tuple(got[n] for n in NAMES) == want
        assert got["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (got["kept"] and got["base_failed"])


def test_rules_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    train = labels.where("doc_id % 2 = 0")
    rules = quality_rules.learn(quality_rules.labelled_statistics(docs, train, "doc_id", "text", 20_000))
    judged = quality_rules.judged(docs.select("doc_id", "text"), rules).withColumnRenamed("quality", "q").join(labels.where("doc_id % 2 = 1"), "doc_id")
    right = judged.agg(F.avg(F.when((F.col("quality") == 1) == F.col("q.kept"), 1.0).otherwise(0.0))).first()[0]
    assert right > 0.9


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_mix_agrees_with_sql(spark, sf):
    assert difference(spark, connect(sf), sf, QUERIES["op3_mixing"], ORACLES["op3_mixing"])[0] is None


def test_mix_of_odd_rows(frame, odd):
    docs = frame(odd)
    plan = mixing.mix(docs).collect()
    assert len(plan) == len(odd)
    assert sorted((r["doc_id"] or 0, r["size"]) for r in plan) == sorted((t[0] or 0, len(WORD.findall(t[1] or ""))) for t in odd)
    assert all(r["taken"] in {k * r["size"] for k in range(4)} for r in plan)
    budget = sum(r["size"] for r in plan)
    assert sum(r["taken"] for r in plan) <= budget
    assert abs(sum({r["source"]: r["target"] for r in plan}.values()) - budget) < 1e-6 * budget
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert out.count() == sum(r["passes"] for r in plan)
    assert mixing.mix(frame([])).count() == 0
    assert mixing.mixed_documents(frame([])).count() == 0


def test_targets_follow_weights(spark):
    rows = [("a", 1000), ("b", 10), ("c", 1000), ("d", 1000), (None, 500), ("zero", 0)]
    got = {r["source"]: r["target"] for r in mixing.source_targets(spark.createDataFrame(rows, "source string, size bigint")).collect()}
    # weights by code point: a 1, b 2, c 3, d 1, zero 2, NULL 3
    left, shares = 3510 - 30, {"a": 1, "c": 3, "d": 1, None: 3}
    one = left / 8
    assert got["b"] == 30 and got["zero"] == 0
    assert 3 * one <= 3 * 500
    assert all(abs(got[s] - w * one) < 1e-6 for s, w in shares.items())

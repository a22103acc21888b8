from collections import Counter

import corpus_pipeline
import duckdb
import pyarrow as pa
from test_dedup import groups_of, kept_lines
from test_rules_and_mixing import WORD, counted

from lakeops import session
from lakeops.llm import lsh_forest, quality_rules
from lakeops.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_registry():
    import __spark_entry__ as driver

    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) == 13
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near-dedup", "mixing", "segmentations"]


def measures(text):
    """What the rules may test, counted in plain Python."""
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words = counted(text)
    found = lambda chars: sum(c in chars for c in text)
    return {
        "n_words": n_words,
        "mean_word": word_chars / max(n_words, 1),
        "symbol_share": n_symbols / max(word_chars, 1),
        "dup_line_share": n_dup_lines / (text.count("\n") + 1),
        "repeat_share": n_repeat_words / max(n_words, 1),
        "distinct_share": len(set(WORD.findall(text))) / max(n_words, 1),
        "upper_share": found("ABCDEFGHIJKLMNOPQRSTUVWXYZ") / max(word_chars, 1),
        "mark_share": found(".,;:!?") / max(word_chars, 1),
        "digit_share": found("0123456789") / max(word_chars, 1),
    }


def passes(rules, text):
    """The verdict by hand: base rules, then the learned list."""
    n_words, _, _, _, n_repeat_words = counted(text)
    values = measures(text or "")
    holds = lambda c: values[c.measure] > c.threshold if c.above else values[c.measure] <= c.threshold
    return n_words >= 50 and 100 * n_repeat_words <= 50 * n_words and not any(all(map(holds, rule)) for rule in rules)


def test_stages_by_brute_force(spark):
    """Each stage on what the one before it kept, against plain Python; the mix against its SQL."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    def through(name, docs):
        return [tuple(r) for r in stages[name](spark, docs, SF).collect()]

    given = [tuple(r) for r in docs.collect()]
    at = {c: i for i, c in enumerate(docs.columns)}
    pairs = lambda rows: [(r[at["doc_id"]], r[at["text"]]) for r in rows]

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rules = quality_rules.learn(quality_rules.labelled_statistics(docs, labels, "doc_id", "text", 20_000))
    good = through("quality rules", docs)
    assert sorted(good, key=repr) == sorted([r for r in given if passes(rules, r[at["text"]])], key=repr)

    lines = through("line dedup", spark.createDataFrame(good, docs.schema))
    want = Counter(zip([i for i, _ in pairs(good)], kept_lines(pairs(good)), strict=True))
    assert Counter(pairs(lines)) == want

    unique = through("near-dedup", spark.createDataFrame(lines, docs.schema))
    group = groups_of(pairs(lines), 5, 80)
    assert sorted(unique, key=repr) == sorted([r for r in lines if group[r[at["doc_id"]]] == r[at["doc_id"]]], key=repr)

    con = duckdb.connect()
    con.register("documents", pa.Table.from_pylist([dict(zip(docs.columns, r, strict=True)) for r in unique]))
    taken = con.execute(f"SELECT doc_id, size, taken FROM ({ORACLES['op3_mixing']})").fetchall()
    mix = through("mixing", spark.createDataFrame(unique, docs.schema))
    assert Counter(r[at["doc_id"]] for r in mix) == Counter({i: t // n if n else 1 for i, n, t in taken if t or not n})  # documents without words stay
    assert set(mix) <= set(unique)


def test_stages_follow_their_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, texts = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "segmentations":
            assert out.columns == columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
            rows = out.collect()
            out = spark.createDataFrame(rows, docs.schema)
        if name == "quality rules":
            judged = QUERIES["op1_quality_rules"](spark, SF).where("kept")
            assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in judged.collect())
        if name == "line dedup":
            assert all(r["n_chars"] == len(r["text"]) for r in rows) and len(rows) == docs.count()
        if name == "near-dedup":
            groups = lsh_forest.near_duplicates(docs, 5, 80)
            assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in groups.where("kept").collect())
        if name == "mixing":
            known = {(r["doc_id"], r["text"]) for r in docs.collect()}
            assert {(r["doc_id"], r["text"]) for r in rows} <= known
            texts = [r["text"] for r in rows]
        docs = out
    assert docs.where("rank = 0").count() == len(texts) and docs.where("NOT decodes").count() == 0
    assert corpus_pipeline.run(spark, SF).where("rank = 0").count() == len(texts)


def test_pipeline_of_an_empty_table(spark):
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0
    assert quality_rules.MIN_WORDS == 50


def test_rows_go_to_python_by_bytes(spark, frame, words, monkeypatch):
    """However long rows are, Python gets few bytes at once: in near-dedup, and in the stages run after they return."""
    default = spark.conf.get(session.ARROW_BYTES)
    seen, linked = [], lsh_forest.linked

    def noted(pairs, *more):
        seen.append(spark.conf.get(session.ARROW_BYTES))
        return linked(pairs, *more)

    monkeypatch.setattr(lsh_forest, "linked", noted)
    docs = frame([(k, " ".join(words(60, 7)) + " x" * (k % 3)) for k in range(6)])
    lsh_forest.near_duplicates(docs)
    assert seen and set(seen) == {str(session.BATCH_BYTES)} and spark.conf.get(session.ARROW_BYTES) == default

    sizes = lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes] * b.num_rows}) for b in batches)
    try:
        for name in ("line dedup", "segmentations"):
            spark.conf.set(session.ARROW_BYTES, default)
            stage = dict(corpus_pipeline.STAGES)[name]
            stage(spark, docs.select("doc_id", "text", "lang", "source", "n_chars"), SF)
            assert spark.conf.get(session.ARROW_BYTES) == str(session.BATCH_BYTES)
        long = spark.range(0, 2000, 1, 1).selectExpr("id", "repeat('x', 10000) AS text")
        assert 0 < long.mapInArrow(sizes, "n long").groupBy().max("n").first()[0] <= 2 * session.BATCH_BYTES
    finally:
        spark.conf.set(session.ARROW_BYTES, default)

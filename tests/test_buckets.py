"""Tables in buckets: what a slice rewrites, and comparing by digests."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakeops.operators.history import classify_changes
from lakeops.operators.rows import delete_matching
from lakeops.operators.upsert import upsert_day
from lakeops.sinks.buckets import BucketTable, change_classes, differing

SCHEMA = "k int, name string, status string, n int"
MATCH = ["k", "name", "status"]


def bag(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


def files(path):
    return {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def some_rows(rng, n, keys):
    return [(rng.choice(keys), rng.choice(["a", "b", None]), rng.choice(["A", "B", None]), rng.randint(1, 4)) for _ in range(n)]


def test_a_slice_rewrites_only_what_it_meets(spark, tmp_path):
    rng = random.Random(1)
    base = spark.createDataFrame(some_rows(rng, 400, [None, *range(200)]), SCHEMA)
    new = spark.createDataFrame(some_rows(rng, 30, [None, 3, 1000]), SCHEMA)
    t = BucketTable(f"file:{tmp_path}/t", ("k",), 50)
    t.create(base)
    before = files(tmp_path / "t" / "rows")
    met = t.merge(new, lambda part, s: upsert_day(part, s, ["k"], "status", MATCH, ["n"]))
    after = files(tmp_path / "t" / "rows")
    rewritten = {int(p.parent.name.split("=")[1]) for p in before.keys() ^ after.keys()}
    assert rewritten == set(met) and len(met) <= 3
    assert all(after[p] == before[p] for p in before.keys() & after.keys())
    assert bag(t.read(spark)) == bag(upsert_day(base, new, ["k"], "status", MATCH, ["n"]))
    # digests are those of a table written at once
    whole = BucketTable(f"file:{tmp_path}/whole", ("k",), 50)
    whole.create(t.read(spark))
    assert differing(spark, t, whole) == [] and bag(t.digests(spark)) == bag(whole.digests(spark))


def test_empty_slice_and_empty_table(spark, tmp_path):
    t = BucketTable(f"file:{tmp_path}/t", ("k",), 4)
    rows = spark.createDataFrame([(1, "a", "A", 1)], SCHEMA)
    t.create(rows)
    assert t.merge(rows.limit(0), lambda part, s: part) == []
    assert bag(t.read(spark)) == bag(rows)
    assert bag(t.read(spark, [])) == []
    t.create(rows.limit(0))
    assert bag(t.read(spark)) == [] and t.read(spark).columns == rows.columns
    assert len(t.merge(rows, lambda part, s: part.unionByName(s))) == 1
    assert bag(t.read(spark)) == bag(rows)


def test_a_merge_may_empty_buckets(spark, tmp_path):
    t, rest = (BucketTable(f"file:{tmp_path}/{name}", ("k",), 16) for name in ("t", "rest"))
    rows = spark.createDataFrame([(k, "a", "A", k) for k in range(20)], SCHEMA)
    t.create(rows)
    t.merge(rows.where("k in (3, 4, 5)"), lambda part, s: delete_matching(part, s, ["k"]))
    rest.create(rows.where("k not in (3, 4, 5)"))
    assert bag(t.read(spark)) == bag(rest.read(spark)) and differing(spark, t, rest) == []
    t.merge(rows, lambda part, s: delete_matching(part, s, ["k"]))
    assert bag(t.read(spark)) == [] and bag(t.digests(spark)) == []


def test_a_merge_that_breaks_off_leaves_rows_and_unknown_digests(spark, tmp_path):
    t, copy = (BucketTable(f"file:{tmp_path}/{name}", ("k",), 8) for name in ("t", "copy"))
    rows = spark.createDataFrame([(k, "a", "A", k) for k in range(40)], SCHEMA)
    t.create(rows)
    copy.create(rows)
    lost = F.when(F.col("n") >= 0, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("n"))
    with pytest.raises(Exception, match="lost"):
        t.merge(rows.where("k = 5"), lambda part, s: part.withColumn("n", lost))
    assert bag(t.read(spark)) == bag(rows)
    assert differing(spark, t, copy) == t.met(rows.where("k = 5"))


def test_copies_and_places_of_null_count(spark, tmp_path):
    def made(name, rows):
        t = BucketTable(f"file:{tmp_path}/{name}", ("k",), 1)
        t.create(spark.createDataFrame(rows, SCHEMA))
        return t

    one = made("one", [(1, "x", None, 1)])
    assert differing(spark, one, made("two", [(1, None, "x", 1)])) == [0]
    assert differing(spark, one, made("twice", [(1, "x", None, 1)] * 3)) == [0]
    assert differing(spark, one, made("same", [(1, "x", None, 1)])) == []


HASHED = "id long, name string, rowhash string"


def snapshot(spark, path, rows):
    t = BucketTable(f"file:{path}", ("id",), 32, ("id", "rowhash"))
    t.create(spark.createDataFrame(rows, HASHED))
    return t


@pytest.mark.parametrize("seed", range(2))
def test_change_classes_by_digest(spark, tmp_path, seed):
    rng = random.Random(seed)
    old = [(i, f"n{i}", f"h{i}") for i in range(300)] + [(None, "none", "h"), (7, "again", "a"), (8, "n", None)]
    new = [r for r in old if r[0] not in (11, 12)] + [(900, "new", "x"), (None, "none", "h")]
    new = [(i, n, "changed") if i in (20, 21) else (i, n, h) for i, n, h in new]
    rng.shuffle(new)
    current, incoming = snapshot(spark, tmp_path / "old", old), snapshot(spark, tmp_path / "new", new)
    changed = differing(spark, current, incoming)
    assert 0 < len(changed) <= 6
    want = classify_changes(spark.createDataFrame(old, HASHED), spark.createDataFrame(new, HASHED), "id")
    assert bag(change_classes(spark, current, incoming, "id")) == bag(want)
    only = change_classes(spark, current, incoming, "id", unchanged=False)
    assert bag(only) == bag(want.where("iud_op != 'N' and not (id is null)").unionByName(only.where("id is null")))

    def spoil(name):
        for p in (tmp_path / name / "rows").rglob("*.parquet"):
            if int(p.parent.name.split("=")[1]) not in changed:
                p.write_bytes(b"not to be opened")

    # buckets without changes are not opened on the current side, and without their rows on neither
    spoil("old")
    assert bag(change_classes(spark, current, incoming, "id")) == bag(want)
    spoil("new")
    told = change_classes(spark, current, incoming, "id", unchanged=False)
    assert bag(told.where("id is not null")) == bag(want.where("iud_op != 'N' and id is not null"))


def test_equal_tables_and_empty_ones(spark, tmp_path):
    rows = [(i, "n", f"h{i}") for i in range(20)]
    a, b = snapshot(spark, tmp_path / "a", rows), snapshot(spark, tmp_path / "b", rows)
    assert differing(spark, a, b) == []
    assert {r["iud_op"] for r in change_classes(spark, a, b, "id").collect()} == {"N"}
    assert change_classes(spark, a, b, "id", unchanged=False).count() == 0
    with pytest.raises(ValueError):
        change_classes(spark, a, BucketTable(b.path, ("id",), 16, ("id", "rowhash")), "id")

"""History against a day-by-day fold, and delete-then-insert against its loop."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from lakeops.operators.history import classify_changes, one_per_day, replay, restore_day, retract
from lakeops.operators.replace import delete_insert_range

OPEN = date(9999, 12, 31)
START = date(2025, 1, 10)
BASE = "id int, name string, from_date date, to_date date, is_current int, rowhash string"
SNAP = "id int, name string, data_date date"


def hashed():
    return F.md5(F.concat(F.col("id").cast("string"), F.coalesce("name", F.lit(""))))



def day(n):
    return START + timedelta(days=n)


def bag(rows):
    return sorted(map(tuple, rows), key=repr)


def fold(base, snaps, first, last, insert_new, change_only):
    """Rows are [id, name, from, to, current]; the hash is left out, the name stands for it."""
    base = [list(r) for r in base]
    d = first
    while d <= last:
        today = [s for s in snaps if s[2] == d and s[0] is not None]
        new = []
        for sid, name, _ in today:
            current = [t for t in base if t[0] == sid and t[4] == 1]
            if not current and not insert_new:
                continue
            if change_only and current and current[0][1] == name:
                continue
            for t in current:
                t[3], t[4] = d - timedelta(days=1), 0
            new.append([sid, name, d, OPEN, 1])
        base += new
        d += timedelta(days=1)
    return base


def random_history(rng):
    base = []
    for i in range(6):
        if rng.random() < 0.7:
            base.append((i, rng.choice("ab"), day(-5), OPEN, 1))
        if rng.random() < 0.5:
            base.append((i, rng.choice("ab"), day(-9), day(-6), 0))
    snaps = [(i, rng.choice("ab"), day(n)) for i in range(8) for n in range(-1, 8) if rng.random() < 0.5]
    return base, snaps + [(None, "a", day(2))]


def frames(spark, base, snaps):
    rows = [(*r, None) for r in base]
    return spark.createDataFrame(rows, BASE).withColumn("rowhash", hashed()), spark.createDataFrame(snaps, SNAP)


@pytest.mark.parametrize("insert_new", [False, True])
@pytest.mark.parametrize("change_only", [False, True])
@pytest.mark.parametrize("seed", range(2))
def test_replay_equals_fold(spark, seed, insert_new, change_only):
    base, snaps = random_history(random.Random(seed))
    got = replay(*frames(spark, base, snaps), "id", day(0), day(6), hashed(), insert_new=insert_new, change_only=change_only)
    want = fold(base, snaps, day(0), day(6), insert_new, change_only)
    assert bag(got.drop("rowhash").collect()) == bag(want)


def test_several_current_rows_are_all_closed(spark):
    base = [(1, "a", day(-3), OPEN, 1), (1, "a", day(-2), OPEN, 1)]
    got = replay(*frames(spark, base, [(1, "b", day(0))]), "id", day(0), day(0), hashed()).drop("rowhash")
    assert bag(got.collect()) == bag(
        [(1, "a", day(-3), day(-1), 0), (1, "a", day(-2), day(-1), 0), (1, "b", day(0), OPEN, 1)]
    )


def test_doubled_snapshot_counts_once(spark):
    snaps = spark.createDataFrame([(1, "a", day(0)), (1, "b", day(0)), (1, "a", day(1))], SNAP)
    assert bag(one_per_day(snaps, "id", "data_date").collect()) == bag([(1, "b", day(0)), (1, "a", day(1))])


def test_retract_and_restore(spark):
    base = [(1, "a", day(-5), day(-1), 0), (1, "b", day(0), OPEN, 1), (2, "c", day(-5), OPEN, 1), (3, "d", None, None, None)]
    snaps = [(1, "x", day(-1)), (9, "n", day(-1))]
    frame, snap = frames(spark, base, snaps)
    undone = retract(frame, day(0), (day(-1), day(-1))).drop("rowhash")
    assert bag(undone.collect()) == bag([(1, "a", day(-5), OPEN, 1), (2, "c", day(-5), OPEN, 1), (3, "d", None, None, None)])
    restored = restore_day(frame, snap, "id", day(0), day(-1), hashed()).drop("rowhash")
    assert bag(restored.collect()) == bag(
        [
            (1, "a", day(-5), day(-2), 0),
            (2, "c", day(-5), OPEN, 1),
            (3, "d", None, None, None),
            (1, "x", day(-1), OPEN, 1),
            (9, "n", day(-1), OPEN, 1),
        ]
    )


def test_change_classes(spark):
    old = spark.createDataFrame([(1, "h1"), (2, "h2"), (3, "h3")], "id int, rowhash string")
    new = spark.createDataFrame([(1, "h1", "a"), (2, "other", "b"), (4, "h4", "c")], "id int, rowhash string, name string")
    got = {r["id"]: r["iud_op"] for r in classify_changes(old, new, "id").collect()}
    assert got == {1: "N", 2: "U", 3: "D", 4: "I"}


ROWS = "k1 string, k2 string, name string, updated int, day int"


def loop(base, slices, first, last):
    for d in range(first, last + 1):
        today = [s for s in slices if s[4] == d]
        keys = {(s[0], s[1]) for s in today if s[0] is not None and s[1] is not None}
        base = [t for t in base if (t[0], t[1]) not in keys]
        grouped = {}
        for k1, k2, name, updated, at in today:
            grouped[(k1, k2, name, at)] = max(updated, grouped.get((k1, k2, name, at), updated))
        base = base + [(k1, k2, name, updated, at) for (k1, k2, name, at), updated in grouped.items()]
    return base


@pytest.mark.parametrize("seed", range(4))
def test_delete_insert_equals_loop(spark, seed):
    rng = random.Random(seed)

    def rows(n, days):
        pick = lambda v: None if rng.random() < 0.2 else rng.choice(v)
        return [(pick("ab"), pick("xy"), rng.choice("pq"), rng.randint(1, 5), rng.choice(days)) for _ in range(n)]

    base, slices = rows(12, [1, 2]) + [("z", "z", "p", 1, 2)], rows(30, range(1, 9))
    args = (spark.createDataFrame(base, ROWS), spark.createDataFrame(slices, ROWS), "day", ["k1", "k2"], ["updated"])
    got = delete_insert_range(*args, last=7)
    assert bag(got.collect()) == bag(loop(base, slices, 3, 7))
    again = delete_insert_range(got, *args[1:], last=7)
    if any(s[4] == 7 for s in slices):
        assert bag(again.collect()) == bag(got.collect())


def test_empty_base_needs_a_start(spark):
    empty = spark.createDataFrame([], ROWS)
    slices = spark.createDataFrame([("a", "x", "p", 1, 5)], ROWS)
    assert delete_insert_range(empty, slices, "day", ["k1", "k2"], ["updated"]).count() == 0
    assert delete_insert_range(empty, slices, "day", ["k1", "k2"], ["updated"], start=1).count() == 1

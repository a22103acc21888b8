"""Upserts against a statement-by-statement fold in plain Python."""

import random

import pytest

from lakeops.operators.upsert import upsert_day, upsert_range

COLUMNS = ["k1", "k2", "name", "status", "who", "updated", "day"]
SCHEMA = "k1 string, k2 string, name string, status string, who string, updated int, day int"
KEYS, STATUS, MATCH, PREFER = ["k1", "k2"], "status", ["k1", "k2", "name", "status", "who"], ["updated"]
AT = {c: i for i, c in enumerate(COLUMNS)}


def equal(a, b, null_safe):
    return a == b if null_safe else a is not None and b is not None and a == b


def differs(a, b, null_safe):
    return a != b if null_safe else a is not None and b is not None and a != b


def rank(row):
    return [(v is not None, v if v is not None else 0) for v in [row[AT[c]] for c in PREFER]] + [
        (v is not None, v if v is not None else "") for v in row
    ]


def fold_day(base, slice_rows, null_safe):
    out = []
    for t in base:
        options = [
            s
            for s in slice_rows
            if all(equal(t[AT[k]], s[AT[k]], null_safe) for k in KEYS) and differs(t[AT[STATUS]], s[AT[STATUS]], null_safe)
        ]
        out.append(max(options, key=rank) if options else t)
    fresh = [s for s in slice_rows if not any(all(equal(t[AT[c]], s[AT[c]], null_safe) for c in MATCH) for t in out)]
    return out + fresh


def random_rows(rng, n, day, statuses, nulls):
    def pick(values, share=nulls):
        return None if rng.random() < share else rng.choice(values)

    return [
        (pick("ab", nulls / 2), pick("xy", nulls / 2), pick(["n1", "n2"]), pick(statuses), pick(["u", "v"]), rng.randint(1, 3), day)
        for _ in range(n)
    ]


def bag(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("seed", range(3))
def test_day_equals_fold(spark, seed, null_safe):
    rng = random.Random(seed)
    base = random_rows(rng, 25, 0, "ABC", 0.15)
    new = random_rows(rng, 15, 1, "ABC", 0.15)
    got = upsert_day(
        spark.createDataFrame(base, SCHEMA), spark.createDataFrame(new, SCHEMA), KEYS, STATUS, MATCH, PREFER, null_safe
    )
    assert bag(got.collect()) == bag(fold_day(base, new, null_safe))


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("statuses,per_day", [("A", 4), ("AB", 2), ("AB", 6), ("ABCD", 8)])
@pytest.mark.parametrize("seed", range(2))
def test_range_equals_fold_of_days(spark, seed, statuses, per_day, null_safe):
    rng = random.Random(seed * 100 + per_day)
    base = random_rows(rng, rng.choice([0, 3, 12]), 0, statuses, 0.1)
    days = [random_rows(rng, rng.randint(0, per_day), d, statuses, rng.choice([0, 0.2])) for d in range(1, 10)]
    want = base
    for rows in days:
        want = fold_day(want, rows, null_safe)
    slices = [r for rows in days for r in rows]
    got = upsert_range(
        spark.createDataFrame(base, SCHEMA),
        spark.createDataFrame(slices, SCHEMA),
        "day",
        KEYS,
        STATUS,
        MATCH,
        PREFER,
        null_safe,
    )
    assert bag(got.collect()) == bag(want)


def test_null_safe_day_is_idempotent(spark):
    base = [("a", "x", "n1", "A", None, 1, 0), (None, "x", "n1", "A", "u", 1, 0)]
    new = [("a", "x", "n1", "B", None, 2, 1), (None, "x", "n2", None, "u", 1, 1), ("b", "y", "n1", "A", None, 1, 1)]
    args = (spark.createDataFrame(new, SCHEMA), KEYS, STATUS, MATCH, PREFER, True)
    once = upsert_day(spark.createDataFrame(base, SCHEMA), *args)
    assert bag(upsert_day(once, *args).collect()) == bag(once.collect())


def test_keys_must_be_matched(spark):
    df = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError):
        upsert_day(df, df, KEYS, STATUS, ["name"])


def test_long_chains_of_days_with_several_statuses(spark):
    rng = random.Random(42)
    base = random_rows(rng, 8, 0, "ABC", 0)
    days = []
    for d in range(1, 40):
        statuses = rng.choice(["A", "B", "AB", "ABC", "AB", "BC"])
        days.append([("a", "x", rng.choice(["n1", "n2"]), s, "u", rng.randint(1, 3), d) for s in statuses])
    want = base
    for rows in days:
        want = fold_day(want, rows, False)
    slices = spark.createDataFrame([r for rows in days for r in rows], SCHEMA)
    got = upsert_range(spark.createDataFrame(base, SCHEMA), slices, "day", KEYS, STATUS, MATCH, PREFER)
    assert bag(got.collect()) == bag(want)


def test_616_days_with_several_statuses_each(spark):
    rng = random.Random(7)
    base, days = random_rows(rng, 6, 0, "ABC", 0), []
    for d in range(1, 617):
        statuses = rng.choice(["AB", "AB", "BC", "ABC", "AC", "A"]) if d < 600 else "AB"
        days.append([(rng.choice("ab"), "x", rng.choice(["n1", "n2"]), s, "u", rng.randint(1, 3), d) for s in statuses])
    want = base
    for rows in days:
        want = fold_day(want, rows, False)
    slices = spark.createDataFrame([r for rows in days for r in rows], SCHEMA)
    got = upsert_range(spark.createDataFrame(base, SCHEMA), slices, "day", KEYS, STATUS, MATCH, PREFER)
    assert bag(got.collect()) == bag(want)


@pytest.mark.parametrize("ending", ["A", "B", "AB", "BA"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_ends_of_chains(spark, ending, null_safe):
    """Runs of one status at the end, after days with several, NULL statuses among them."""
    rng = random.Random(len(ending) + null_safe)
    base, days = random_rows(rng, 12, 0, "ABC", 0.1), []
    for d in range(1, 15):
        statuses = [rng.choice(["A", "B", "C", None]) for _ in range(rng.randint(1, 3))] if d < 11 else list(ending)
        days.append([(rng.choice("ab"), "x", rng.choice(["n1", "n2"]), s, "u", rng.randint(1, 3), d) for s in statuses])
    want = base
    for rows in days:
        want = fold_day(want, rows, null_safe)
    slices = spark.createDataFrame([r for rows in days for r in rows], SCHEMA)
    got = upsert_range(spark.createDataFrame(base, SCHEMA), slices, "day", KEYS, STATUS, MATCH, PREFER, null_safe)
    assert bag(got.collect()) == bag(want)

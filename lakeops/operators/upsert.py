"""Upsert in place: rows of known keys follow the slice's status, unseen rows are added.

One day means two steps. First every base row with the key of a slice row but another status becomes that slice row in
all columns. Then every slice row goes in that equals no base row, as just updated, on the match columns. If several
slice rows could replace a base row, the one greatest by `prefer` and then by all columns does.

With plain comparison NULL equals nothing: a NULL status is never replaced, and a slice row with NULL in a match column
goes in each time. With `null_safe` NULL is a value like others, and loading a day again changes nothing as long as a
key has one status in it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeops.operators.rows import join_on
from lakeops.session import materialize


def _two_best(
    rows: DataFrame, group: Sequence[str], status: str, columns: Sequence[str], prefer: Sequence[str]
) -> DataFrame:
    """Per group: `_s1`, the best slice row, and `_s2`, the best one of another status (NULL if there is none).

    A base row of the first one's status turns into the second, any other into the first, so no more candidates are
    needed. Rows are reduced to one per (group, status) before the first shuffle, to two per group before the second.
    """
    rank = [F.col(c).alias(f"p{i}") for i, c in enumerate(prefer)]
    best = F.max(F.struct(*rank, F.struct(*columns).alias("row"))).alias("_best")
    order = W.partitionBy(*group).orderBy(F.col("_best").desc())
    top = rows.groupBy(*group, status).agg(best).withColumn("_n", F.row_number().over(order)).where("_n <= 2")
    return top.groupBy(*group).agg(
        F.max(F.when(F.col("_n") == 1, F.col("_best.row"))).alias("_s1"),
        F.max(F.when(F.col("_n") == 2, F.col("_best.row"))).alias("_s2"),
    )


def _differs(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)


def _usable(df: DataFrame, columns: Sequence[str], null_safe: bool) -> DataFrame:
    return df if null_safe else df.dropna(subset=list(columns))


def _replaced(df: DataFrame, new: Column, columns: Sequence[str]) -> DataFrame:
    return df.select([F.when(new.isNotNull(), new[c]).otherwise(F.col(c)).alias(c) for c in columns])


def upsert_day(
    base: DataFrame,
    day_slice: DataFrame,
    keys: Sequence[str],
    status: str,
    match: Sequence[str],
    prefer: Sequence[str] = (),
    null_safe: bool = False,
) -> DataFrame:
    """The base after one slice. All columns of `base` must be in `day_slice`; `match` must contain the keys.

    The slice's candidates, two rows per key at most, are written to the scratch folder when this is called, so that the
    join with the base knows their size; the result itself is lazy.
    """
    if not set(keys) <= set(match):
        raise ValueError("match columns must contain the keys")
    columns = base.columns
    rows = day_slice.select(columns)
    best = materialize(_two_best(_usable(rows, [*keys, status], null_safe), keys, status, columns, prefer), "best")

    def update(how: str) -> DataFrame:
        joined = join_on(base, best, keys, how, null_safe)
        mine, first, second = F.col(status), F.col("_s1"), F.col("_s2")
        known = mine.isNotNull() | F.lit(null_safe)
        to_first = first.isNotNull() & _differs(mine, first[status])
        new = F.when(known & to_first, first).when(known & first.isNotNull(), second)
        return _replaced(joined, new, columns)

    # only base rows of the slice's keys can equal a slice row, and copies of one row need to be sent only once
    touched = update("inner").select(*match).distinct()
    fresh = join_on(rows, touched, match, "left_anti", null_safe)
    return update("left").unionByName(fresh)


def upsert_range(
    base: DataFrame,
    slices: DataFrame,
    day: str,
    keys: Sequence[str],
    status: str,
    match: Sequence[str],
    prefer: Sequence[str] = (),
    null_safe: bool = False,
) -> DataFrame:
    """The base after all days of `slices` in order, without a job per day.

    It rests on two facts about a key on a day with slice rows of known status:

    - afterwards the key's base rows have exactly the statuses of that day's slice rows, as rows of another status are
      replaced and each slice row is in the base, added or already there;
    - a row outlives the day unreplaced only if its status is the day's only one.

    So whether a slice row finds its equal in the base follows from small per-key tables of days, and what a row ends up
    as from the days' maps of statuses, composed for all days at once (see `_ends`). Work is linear in days. A group in these has no more rows than there are days (times statuses). Base and slices are each joined with
    tables of one row per key, status and day, and so stay splittable when a key is hot.

    The per-key tables are written to the scratch folder when this is called; the result itself is lazy. The base is
    read twice and the slices four times, however many days there are.
    """
    if not set(keys) <= set(match) or status not in match:
        raise ValueError("match columns must contain the keys and the status")
    columns, keys, match = base.columns, list(keys), list(match)
    no_day = F.struct(F.lit(0).alias("known"), F.lit(None).cast(slices.schema[day].dataType).alias("day"))
    staged = slices.withColumn("_at", F.struct(F.lit(1).alias("known"), F.col(day).alias("day"))).select(*columns, "_at")
    usable = _usable(staged, [*keys, status], null_safe)

    # the base stands before all days, with the tuples it has for the slices' keys
    old = _usable(base.select(match), [*keys, status], null_safe)
    slice_keys = materialize(usable.select(keys).distinct(), "keys")
    old = join_on(old, slice_keys, keys, "left_semi", True).distinct()
    tuples = materialize(usable.select(*match, "_at").distinct().unionByName(old.withColumn("_at", no_day)), "tuples")
    statuses = materialize(tuples.select(*keys, status, "_at").distinct(), "statuses")
    days = materialize(_days(usable, statuses, keys, status, columns, prefer), "days")
    final = materialize(_final(statuses, days, keys, status, no_day), "final")

    found = _found(tuples, days, keys, match, no_day)
    fresh = join_on(staged, found, [*match, "_at"], "left_anti", null_safe)

    def settle(rows: DataFrame) -> DataFrame:
        return _replaced(join_on(rows, final, [*keys, status, "_at"], "left", null_safe), F.col("_row"), columns)

    return settle(base.withColumn("_at", no_day)).unionByName(settle(fresh))


def _days(
    usable: DataFrame, statuses: DataFrame, keys: list[str], status: str, columns: list[str], prefer: Sequence[str]
) -> DataFrame:
    """Per (key, day): the candidates `_s1` and `_s2`; whether base rows turned into them, `_to_s1` and `_to_s2`; the
    day's only status, `_only`, if it has one; whether it was the day before's only one too, `_goes_on`; and the day
    before that run of days, `_anchor`."""
    by_key = W.partitionBy(*keys).orderBy("_at")
    one = F.struct(status)
    chain = (
        statuses.groupBy(*keys, "_at")
        .agg(F.min(one).alias("_low"), F.max(one).alias("_high"))
        .withColumn("_only", F.when(F.col("_low") == F.col("_high"), F.col("_low")))
        .withColumn("_prev", F.lag("_at").over(by_key))
        .withColumn("_prev_only", F.lag("_only").over(by_key))
        .withColumn("_goes_on", F.coalesce(F.col("_only") == F.col("_prev_only"), F.lit(False)))
        .withColumn("_run", F.sum(F.when(F.col("_goes_on"), 0).otherwise(1)).over(by_key))
        .withColumn("_anchor", F.first("_prev").over(W.partitionBy(*keys, "_run").orderBy("_at")))
        .drop("_low", "_high", "_run")
    )
    last_there = F.lag("_at").over(W.partitionBy(*keys, status).orderBy("_at"))
    there = statuses.withColumn("_there", last_there).withColumnRenamed(status, "_first")
    best = _two_best(usable, [*keys, "_at"], status, columns, prefer).withColumn("_first", F.col("_s1")[status])
    # the narrow tables are joined first, the wide candidates once
    joined = join_on(best, join_on(there, chain, [*keys, "_at"], "inner", True), [*keys, "_at", "_first"], "inner", True)
    only_first = F.coalesce(F.col("_prev_only") == F.struct(F.col("_first").alias(status)), F.lit(False))
    return joined.select(
        *keys,
        "_at",
        "_s1",
        "_s2",
        "_only",
        "_goes_on",
        "_anchor",
        (F.col("_prev").isNotNull() & ~only_first).alias("_to_s1"),
        F.coalesce(F.col("_there") == F.col("_prev"), F.lit(False)).alias("_to_s2"),
    )


def _found(tuples: DataFrame, days: DataFrame, keys: list[str], match: list[str], no_day: Column) -> DataFrame:
    """The (tuple, day) pairs of the slices for which the base already has an equal row once updated that day."""

    def equals(row: str) -> Column:
        out = F.col(row).isNotNull()
        for c in match:
            out = out & F.col(row)[c].eqNullSafe(F.col(c))
        return out

    before = F.lag("_at").over(W.partitionBy(*match).orderBy("_at"))
    seen = tuples.withColumn("_seen", before).where("_at.known = 1")
    lasted = F.col("_only").isNotNull() & (F.col("_seen") >= F.coalesce(F.col("_anchor"), no_day))
    became = (F.col("_to_s1") & equals("_s1")) | (F.col("_to_s2") & equals("_s2"))
    joined = join_on(seen, days, [*keys, "_at"], "inner", True)
    return joined.where(F.coalesce(lasted, F.lit(False)) | became).select(*match, "_at")


def _ends(days: DataFrame, keys: list[str], status: str, no_day: Column) -> DataFrame:
    """Per (key, day), and per key for the time before all days: what becomes of a row on the days that follow.

    A day is a map from status to status: all but its first status go to the first, the first goes to the second, or
    stays if the day has no other. After it a row has one of two statuses, so from one day to the next there are three
    maps between these: both to the first (`_meets`), each to the other (`_turns`), each to itself. Maps of this kind
    compose by counting: from the last `_meets` on, or from the row's own day if that is later, only whether the turns
    are even or odd matters. Running counts over a key's days give that for all days at once, in time linear in days.

    The last day replaces every row if it has two statuses. If it has one, rows that have it since before the run of
    days with that only status stay, and were put in place on the day before the run; all others came with the run.

    `_next` is the day after this one with its statuses `first` and `second`, whether it has `two`, and where rows end
    that it makes its first or second, `_end1` and `_end2`: the day and the candidate, NULL if they stay.
    """
    state = F.struct(F.col("_s1")[status].alias("first"), F.col("_s2")[status].alias("second"), F.col("_s2").isNotNull().alias("two"))
    start = F.lit(None).cast(days.select(state.alias("s")).schema["s"].dataType)
    marks = days.select(*keys, "_at", state.alias("_state")).unionByName(
        days.select(*keys).distinct().select(*keys, no_day.alias("_at"), start.alias("_state"))
    )
    by_key = W.partitionBy(*keys).orderBy("_at")
    whole, so_far = by_key.rowsBetween(W.unboundedPreceding, W.unboundedFollowing), by_key.rowsBetween(W.unboundedPreceding, 0)
    real, two, before = F.col("_state").isNotNull(), F.col("_state.two"), F.col("_before")
    same = lambda a, b: F.col(f"_state.{a}").eqNullSafe(before[b])
    turns = real & before.isNotNull() & two & same("first", "first")
    stays = real & before.isNotNull() & two & before["two"] & same("first", "second")
    begins = real & ~F.coalesce(~two & ~before["two"] & same("first", "first"), F.lit(False))  # a run of days of one status
    seen = (
        marks.withColumn("_before", F.lag("_state").over(by_key))
        .withColumn("_day_before", F.when(before.isNotNull(), F.lag("_at").over(by_key)))
        .withColumn("_turns", F.sum(F.when(turns, 1).otherwise(0)).over(so_far))
        .withColumn("_meets", F.when(real & ~F.coalesce(turns | stays, F.lit(False)), F.struct("_at", "_turns")))
        .withColumn("_met", F.last("_meets", ignorenulls=True).over(so_far))
        .withColumn("_run", F.last(F.when(begins, F.struct("_at", "_day_before", "_before", F.col("_state.first").alias("only"))), ignorenulls=True).over(so_far))
    )
    # the last day with two statuses that has a say: the last day of all, or the one before the last run
    final = F.struct("_at", "_state", "_turns", "_met")
    told = (
        seen.withColumn("_last", F.last(final).over(whole))
        .withColumn("_run", F.last("_run").over(whole))
        .withColumn("_prior", F.last(F.when(F.col("_at") == F.col("_run._day_before"), final), ignorenulls=True).over(whole))
    )

    def at(day: Column, x: int) -> Column:
        """Which of `day`'s two statuses a row has then that has the x-th after this row's day."""
        met = day["_met"]
        odd = F.when(met["_at"] > F.col("_at"), day["_turns"] - met["_turns"]).otherwise(day["_turns"] - F.col("_turns") + x - 1)
        return F.when(odd % 2 == 0, 1).otherwise(2)

    def end(x: int) -> Column:
        def put(day: Column, which: Column) -> Column:
            return F.struct(day.alias("at"), which.alias("which"))

        last, prior, run = F.col("_last"), F.col("_prior"), F.col("_run")
        there = at(prior, x)
        of_prior = F.when(there == 1, prior["_state"]["first"]).otherwise(prior["_state"]["second"])
        kept = prior.isNotNull() & (F.col("_at") <= prior["_at"]) & prior["_state"]["two"] & of_prior.eqNullSafe(run["only"])
        by_run = (
            F.when(F.col("_at") >= run["_at"], F.lit(None))
            .when(kept & (F.col("_at") < prior["_at"]), put(prior["_at"], there))
            .when(~F.coalesce(kept, F.lit(False)), put(run["_at"], F.lit(1)))
        )
        by_last = F.when(F.col("_at") < last["_at"], put(last["_at"], at(last, x)))
        return F.when(last["_state"]["two"], by_last).otherwise(by_run)

    following = F.struct("_at", "_state.*", end(1).alias("_end1"), end(2).alias("_end2"))
    return told.select(*keys, "_at", following.alias("_this")).select(*keys, "_at", F.lead("_this").over(by_key).alias("_next"))


def _final(statuses: DataFrame, days: DataFrame, keys: list[str], status: str, no_day: Column) -> DataFrame:
    """What a row of some status, in the base since some day, is in the end: (key, status, day) -> `_row`. Rows that
    stay as they are are not listed."""
    following, mine = F.col("_next"), F.col(status)
    put = lambda which: F.struct(following["_at"].alias("at"), F.lit(which).alias("which"))
    end = (
        F.when(_differs(mine, following["first"]), F.coalesce(following["_end1"], put(1)))
        .when(following["two"], F.coalesce(following["_end2"], put(2)))
        .otherwise(following["_end1"])
    )
    moved = (
        join_on(statuses, _ends(days, keys, status, no_day).where(following.isNotNull()), [*keys, "_at"], "inner", True)
        .withColumn("_end", end)
        .where("_end is not null")
        .select(*keys, status, F.col("_at").alias("_since"), F.col("_end.at").alias("_at"), F.col("_end.which").alias("_which"))
    )
    ends = days.select(*keys, "_at", "_s1", "_s2")
    row = F.when(F.col("_which") == 1, F.col("_s1")).otherwise(F.col("_s2"))
    return join_on(moved, ends, [*keys, "_at"], "inner", True).select(*keys, status, F.col("_since").alias("_at"), row.alias("_row"))

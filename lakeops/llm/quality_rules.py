"""Quality rules: a decision list learned from labelled documents and applied as one Spark expression.

Per document a few statistics of its whole text are computed with built-in functions. From the labelled documents,
sequential covering learns an ordered list of rules, each a conjunction of thresholds such as
`symbol_share > 0.04 AND mean_word <= 7.1`. A rule grows by the condition of greatest information gain on two thirds of
the labelled rows and is pruned from its end on the rest. All counting is Spark aggregation over (statistic, bin,
class); the driver sees those counts only, whose number is fixed by `bins`. The list is emitted as one `CASE WHEN`.

Only the labelled rows are bounded: `max_labelled` of them, the least by hash of doc_id. Documents are never sampled.

Edge cases: NULL or empty text has no words and fails the base rules. Repeated documents and ties are judged alike, row
by row. Labels that are NULL do not count; of several labels of one document the worst counts. Without labels, or with
labels of one class only, the list is empty and only the base rules decide.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.words import GAP_CHARS, let, words
from lakeops.session import materialize

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def repeat_words(w: Column) -> Column:
    """Words of `w` that lie in a window of three words found at least twice in `w`.

    Windows are compared by 64-bit hash. Sorting them with their places brings equal ones together; the places found
    are sorted again, so the words they cover are a sum of gaps of at most three. No step is quadratic in the text.
    """

    def covered(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            same = lambda e, k: F.coalesce(e["h"] == F.get(s, k - 1)["h"], F.lit(False)) | F.coalesce(e["h"] == F.get(s, k + 1)["h"], F.lit(False))
            return F.sort_array(F.transform(F.filter(s, same), lambda e: e["i"]))

        gaps = lambda p: F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
        total = lambda p: F.aggregate(gaps(p), F.lit(0), lambda a, x: a + x)
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(let(placed, places), total))

    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(F.size(w) < 3, F.lit(0)).otherwise(let(windows, covered))


def statistics(text: Column) -> Column:
    """A struct of counts over the whole text."""
    text = F.coalesce(text, F.lit(""))
    without = lambda t, chars: F.length(t) - F.length(F.translate(t, chars, ""))

    def of(both: Column) -> Column:
        t, w = both["t"], both["w"]
        lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, GAP_CHARS, "")) > 0)
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.translate(t, GAP_CHARS, "")).cast("long").alias("word_chars"),
            without(t, SYMBOLS).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeat_words(w).cast("long").alias("n_repeat_words"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
            without(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("long").alias("n_upper"),
            without(t, ".,;:!?").cast("long").alias("n_marks"),
            without(t, "0123456789").cast("long").alias("n_digits"),
            F.size(F.split(t, "\n")).cast("long").alias("n_lines"),
        )

    return let(F.struct(text.alias("t"), words(text).alias("w")), of)


def base_failed(s: Column) -> Column:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])


#: Name of each measure a rule may test, and how it follows from the statistics.
MEASURES = {
    "n_words": lambda s: s["n_words"].cast("double"),
    "mean_word": lambda s: s["word_chars"] / F.greatest(s["n_words"], F.lit(1)),
    "symbol_share": lambda s: s["n_symbols"] / F.greatest(s["word_chars"], F.lit(1)),
    "dup_line_share": lambda s: s["n_dup_lines"] / F.greatest(s["n_lines"], F.lit(1)),
    "repeat_share": lambda s: s["n_repeat_words"] / F.greatest(s["n_words"], F.lit(1)),
    "distinct_share": lambda s: s["n_distinct"] / F.greatest(s["n_words"], F.lit(1)),
    "upper_share": lambda s: s["n_upper"] / F.greatest(s["word_chars"], F.lit(1)),
    "mark_share": lambda s: s["n_marks"] / F.greatest(s["word_chars"], F.lit(1)),
    "digit_share": lambda s: s["n_digits"] / F.greatest(s["word_chars"], F.lit(1)),
}


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool
    threshold: float

    def test(self, s: Column) -> Column:
        value = MEASURES[self.measure](s)
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.measure} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def fires(rule: Rule, s: Column) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.test(s)
    return out


def first_rule(rules: list[Rule], s: Column) -> Column:
    """Number of the first rule of the list that fires, from 0; NULL if none does."""
    out = F.lit(None).cast("int")
    for k in reversed(range(len(rules))):
        out = F.when(fires(rules[k], s), F.lit(k)).otherwise(out)
    return out


def labelled_statistics(documents: DataFrame, labels: DataFrame, id_col: str, text_col: str, max_labelled: int) -> DataFrame:
    """Statistics of up to `max_labelled` labelled documents that pass the base rules, with `bad` and the part they train.

    The labels are few by that bound, so they may be sent to all tasks and no text is shuffled.
    """
    y = labels.where(F.col("quality").isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg((F.min("quality") < 1).alias("bad"))
    y = y.orderBy(F.xxhash64("_id"), "_id").limit(max_labelled)
    docs = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    # written before the filter below, which Spark would else compute for all documents ahead of the join
    rows = materialize(docs.join(F.broadcast(y), "_id").select("_id", "bad", statistics(F.col("_text")).alias("s")), "quality-labelled")
    return rows.where(~base_failed(F.col("s"))).select("bad", (F.pmod(F.xxhash64("_id", F.lit(7)), F.lit(3)) == 0).alias("prunes"), "s")


def learn(rows: DataFrame, bins: int = 32, max_rules: int = 8, max_conditions: int = 3, min_precision: float = 0.98, min_hits: int = 5) -> list[Rule]:
    """The decision list for rows of (bad, prunes, s), as `labelled_statistics` gives them."""
    steps = [k / bins for k in range(1, bins)]
    cut = rows.agg(*[F.percentile_approx(f(F.col("s")), steps, 10000).alias(m) for m, f in MEASURES.items()]).first().asDict()
    cuts = {m: sorted(set(v)) for m, v in cut.items() if v}
    if not cuts:
        return []

    def gained(rule: Rule, part: Column) -> dict:
        """(bad, good) of the rows in `part` that no earlier rule took and `rule` keeps, by measure and bin."""
        left = rows.where(part & first_rule(found, F.col("s")).isNull() & fires(rule, F.col("s")))
        bin_of = lambda m: F.size(F.filter(F.array(*[F.lit(float(t)) for t in cuts[m]]), lambda t: t < MEASURES[m](F.col("s"))))
        cells = left.select("bad", F.explode(F.array(*[F.struct(F.lit(m).alias("m"), bin_of(m).alias("b")) for m in cuts])).alias("c"))
        out: dict = {}
        for r in cells.groupBy("c.m", "c.b", "bad").count().collect():
            out.setdefault(r["m"], {}).setdefault(r["b"], [0, 0])[0 if r["bad"] else 1] += r["count"]
        return out

    def hits(rules: list[Rule], part: Column) -> list[tuple[int, int]]:
        """(bad, good) each of the given rules takes of the rows that no earlier rule took."""
        left = rows.where(part & first_rule(found, F.col("s")).isNull())
        sums = []
        for rule in rules:
            sums += [F.count_if(fires(rule, F.col("s")) & F.col("bad")), F.count_if(fires(rule, F.col("s")) & ~F.col("bad"))]
        got = left.agg(*[x.alias(f"c{k}") for k, x in enumerate(sums)]).first()
        return [(got[2 * k], got[2 * k + 1]) for k in range(len(rules))]

    share = lambda p, n: p / (p + n) if p + n else 0.0
    found: list[Rule] = []
    barred: set[str] = set()  # measures whose rules did not hold on the rows kept for pruning
    while len(found) < max_rules:
        rule: Rule = ()
        while len(rule) < max_conditions:
            cells = gained(rule, ~F.col("prunes"))
            rivals, most = [], 1e-9  # conditions of the greatest gain, and how far the next cut is
            for m, by_bin in sorted(cells.items()):
                if not rule and m in barred:
                    continue
                p0, n0 = (sum(v[k] for v in by_bin.values()) for k in (0, 1))
                if not p0 or not n0:
                    continue
                p_low = n_low = 0
                for b, t in enumerate(cuts[m]):
                    p_low, n_low = p_low + by_bin.get(b, [0, 0])[0], n_low + by_bin.get(b, [0, 0])[1]
                    for above, p, n in ((False, p_low, n_low), (True, p0 - p_low, n0 - n_low)):
                        gain = p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p >= min_hits else 0.0
                        if gain > most + 1e-9:
                            rivals, most = [], gain
                        if gain > most - 1e-9:
                            rivals.append((Condition(m, above, float(t)), (cuts[m][min(b + 1, len(cuts[m]) - 1)] - t) / ((cuts[m][-1] - cuts[m][0]) or 1)))
            if not rivals:
                break
            # of equal ones that which holds best on the rows kept for pruning, then the one with the widest gap behind it
            held = hits([(*rule, c) for c, _ in rivals], F.col("prunes")) if len(rivals) > 1 else [(0, 0)]
            rule = (*rule, max(zip(held, rivals, strict=True), key=lambda x: (share(*x[0]), x[0][0], x[1][1]))[1][0])
        if not rule:
            break
        shorter = [rule[:k] for k in range(1, len(rule) + 1)]
        pruned = hits(shorter, F.col("prunes"))
        worth = [share(p, n) - (1 if p == 0 else 0) for p, n in pruned]
        rule = shorter[max(range(len(shorter)), key=lambda k: (worth[k], -k))]
        (p, n), = hits([rule], F.lit(True))
        if p >= min_hits and share(p, n) >= min_precision:
            found.append(rule)
        else:
            barred.add(rule[0].measure)
    return found


def judged(documents: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """`documents` with a column `quality`: the statistics, `base_failed`, `rule` (the first that fires) and `kept`."""

    def verdict(s: Column) -> Column:
        of = lambda v: F.struct(s.alias("s"), v["failed"].alias("base_failed"), v["rule"].alias("rule"), (~v["failed"] & v["rule"].isNull()).alias("kept"))
        return let(F.struct(base_failed(s).alias("failed"), first_rule(rules, s).alias("rule")), of)

    return documents.withColumn("quality", let(statistics(F.col(text_col)), verdict))


def kept_documents(documents: DataFrame, labels: DataFrame, max_labelled: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that pass the base rules and every learned rule, with their own columns only."""
    rules = learn(labelled_statistics(documents, labels, id_col, text_col, max_labelled))
    s = lambda s: ~base_failed(s) & first_rule(rules, s).isNull()
    return documents.where(let(statistics(F.col(text_col)), s))

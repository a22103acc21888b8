"""Words that differ by one code point, by composing automata, and the forms that rare spellings lead to.

A vocabulary is put into acceptors, and every pair of words one edit apart is a path accepted by acceptor o edits o
acceptor, where the transducer in the middle copies, and once inserts, deletes or replaces a code point. The composed
machine is never written down: its states are walked from the initial one, and the part behind the edit, an
intersection of two states of a minimised acceptor, is judged once for each pair of states.

Partitions. Words of m code points and a near one of m or m + 1 agree in the first or in the last half of what m leaves
beside the edit. So each word is put, for m its own length and one less, into a partition named by its first half and one
named by its last half; the acceptor of a partition starts where that context leads. A partition of more than
`group_words` words is parted again by halves of what its context leaves, as often as needed; once one code point is left,
it has at most (letters + letters squared) words. A pair is taken from exactly one partition: the one that always chose
the first half where the words agree there.

Edge cases: NULL texts have no words; a NULL id is an empty one. Very long texts are read whole, batch by batch. Repeated rows and repeated words count as often as they
occur. Ties between near words are decided by n, then by code points. Empty tables give no words. Only the two named columns
are read, whatever others are called.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.session import materialize

RUN = re.compile("[A-Za-zÀ-ÿ]+")
FLUSH = 200_000
GROUP_WORDS = 20_000
#: What names a partition: length of the shorter words, code points of context on either side, the bound of agreement, the context.
NAMES = ["size", "head", "tail", "agree", "context"]
Shape = tuple[tuple[str, int], ...]


def plain(key, run: str) -> str:
    return run


def misspelt(one_in: int) -> Callable[[object, str], str]:
    """Runs whose crc32 with the document's id is divisible by `one_in` lose the code point that it names."""

    def change(key, run: str) -> str:
        h = zlib.crc32(f"{key}:{run}".encode())
        return run if h % one_in else run[: h % len(run)] + run[h % len(run) + 1 :]

    return change


def word_counts(documents: DataFrame, change: Callable[[object, str], str] = plain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): runs of letters of all texts, A-Z lower-cased, `change(id, run)` applied, the empty one left out."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for key, text in zip(batch["key"], batch["text"], strict=True):
                runs = Counter(RUN.findall(text.encode().lower().decode()))
                for run, n in runs.items():
                    counts[change(key, run)] += n
                if len(counts) > FLUSH:
                    yield pd.DataFrame(list(counts.items()), columns=["word", "n"])
                    counts.clear()
        if counts:
            yield pd.DataFrame(list(counts.items()), columns=["word", "n"])

    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))  # as text: pandas would make numbers with NULLs inexact
    docs = documents.where(F.col(text_col).isNotNull()).select(key.alias("key"), F.col(text_col).alias("text"))
    found = docs.mapInPandas(rows, "word string, n bigint").where("word != ''")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


class Acceptor:
    """The minimised acceptor of some words given in order: states are numbers, equal right languages are one state."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self.known: dict[tuple[bool, Shape], int] = {}
        self.meets: dict[tuple[int, int], bool] = {}
        open_: list[tuple[bool, dict[str, int], str]] = [(False, {}, "")]  # states of the last word, and the arc into each
        last = ""
        for word in words:
            same = 0
            while same < min(len(word), len(last)) and word[same] == last[same]:
                same += 1
            self.close(open_, same + 1)
            open_.extend((False, {}, c) for c in word[same:])
            open_[-1] = (True, *open_[-1][1:])
            last = word
        self.close(open_, 1)
        self.start = self.state(open_[0][0], open_[0][1])

    def close(self, open_: list[tuple[bool, dict[str, int], str]], depth: int) -> None:
        while len(open_) > depth:
            final, arcs, by = open_.pop()
            open_[-1][1][by] = self.state(final, arcs)

    def state(self, final: bool, arcs: dict[str, int]) -> int:
        shape = (final, tuple(arcs.items()))
        if shape not in self.known:
            self.known[shape] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return self.known[shape]

    def meet(self, p: int, q: int) -> bool:
        """Whether some rest is accepted from both states."""
        todo = [(p, q)]
        while todo:
            p, q = todo[-1]
            answer = self.told(p, q)
            if answer is None:
                after = self.common(p, q)
                told = [self.told(*pair) for pair in after]
                if True not in told and None in told:
                    todo.append(after[told.index(None)])
                    continue
                answer = self.meets[p, q] = True in told
            todo.pop()
        return answer

    def told(self, p: int, q: int) -> bool | None:
        return True if p == q or (self.final[p] and self.final[q]) else self.meets.get((p, q))

    def common(self, p: int, q: int) -> list[tuple[int, int]]:
        a, b = self.arcs[p], self.arcs[q]
        return [(a[c], b[c]) for c in a.keys() & b.keys()]

    def rests(self, p: int, q: int, unlike: str = "") -> Iterator[str]:
        """All rests accepted from both states that don't begin with `unlike`."""
        stack = [(p, q, "")]
        while stack:
            p, q, rest = stack.pop()
            if self.final[p] and self.final[q]:
                yield rest
            a, b = self.arcs[p], self.arcs[q]
            stack.extend((a[c], b[c], rest + c) for c in a.keys() & b.keys() if (rest or c != unlike) and self.meet(a[c], b[c]))

    def near(self, agree: int) -> Iterator[tuple[str, str]]:
        """Each pair of words one edit apart, once, whose common beginning is shorter than `agree`."""
        stack = [(self.start, "")]
        while stack:
            p, head = stack.pop()
            if len(head) >= agree:
                continue
            arcs = self.arcs[p]
            steps = list(arcs.items())  # in the order of code points, as the words came
            stack.extend((q, head + c) for c, q in steps)
            for k, (x, after_x) in enumerate(steps):
                for y, after_y in steps[k + 1 :]:
                    if self.meet(after_x, after_y):
                        for rest in self.rests(after_x, after_y):
                            yield head + x + rest, head + y + rest
                # of several equal code points in a row the last counts as the one that goes: the rest begins with another
                for rest in self.rests(after_x, p, unlike=x):
                    yield head + x + rest, head + rest


def near_in_group(size: int, head: int, tail: int, agree: int, n: dict[str, int]) -> list[tuple[str, int, int, str]]:
    """Near words of a partition's words: (word, n_near, best_n, best) for each word that has any."""
    first = next(iter(n))
    before, after = first[:head], first[len(first) - tail :]
    found: dict[str, list] = {}
    middles = sorted(w[head : len(w) - tail] for w in n)
    for a, b in Acceptor(middles).near(agree - head):
        if min(len(a), len(b)) + head + tail == size:
            a, b = before + a + after, before + b + after
            for w, v in ((a, b), (b, a)):
                at = found.setdefault(w, [0, 0, ""])
                at[0] += 1
                if (-n[v], v) < (-at[1], at[2]):
                    at[1:] = n[v], v
    return [(w, *x) for w, x in found.items()]


def near_in_partitions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """`near_in_group` of partitions that come one after the other, a row a word."""

    def groups() -> Iterator[list[tuple]]:
        open_, name = {}, None
        for batch in batches:
            for *named, word, n in zip(*(batch[c].tolist() for c in [*NAMES, "word", "n"]), strict=True):
                if named != name:
                    if len(open_) > 1:
                        yield near_in_group(*name[:4], open_)
                    open_, name = {}, named
                open_[word] = n
        if len(open_) > 1:
            yield near_in_group(*name[:4], open_)

    out: list[tuple] = []
    for rows in groups():
        out.extend(rows)
        if len(out) > FLUSH:
            yield pd.DataFrame(out, columns=["word", "n_near", "best_n", "best"])
            out = []
    yield pd.DataFrame(out, columns=["word", "n_near", "best_n", "best"])


def halves(words: DataFrame) -> DataFrame:
    """Each word's partitions of the next level: a half of what is left after `head` and before `tail` becomes context."""
    half = F.expr("(size - head - tail) div 2")  # (left - 1) / 2, rounded up
    first = words.select("word", "n", "size", (F.col("head") + half).alias("head"), "tail", "agree")
    # where the words agree in the first half as well, the pair is taken there
    last = words.select("word", "n", "size", "head", (F.col("tail") + half).alias("tail"), F.least("agree", F.col("head") + half).alias("agree"))
    named = first.unionByName(last)
    return named.withColumn("context", F.concat_ws(" ", F.substr("word", F.lit(1), F.col("head")), F.expr("right(word, tail)")))


def near_words(vocabulary: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """For each word of (word, n) with near words: (word, n_near, form_n, form), the near word of greatest n, the least of equal ones."""
    lengths = F.explode(F.array(F.char_length("word"), F.char_length("word") - 1))
    words = vocabulary.select("word", "n", lengths.alias("size")).where("size > 0")
    start = words.select("*", F.lit(0).alias("head"), F.lit(0).alias("tail"), F.lit(1 << 30).alias("agree"))
    found, todo = None, start
    while True:
        parted = materialize(halves(todo), "spelling-partitions")
        sizes = parted.groupBy(NAMES).agg(F.count("*").alias("members"))
        # where one code point is left beside the context, a partition is bounded by the letters
        full = materialize(sizes.where((F.col("members") > group_words) & F.expr("size - head - tail > 1")).drop("members"), "spelling-full")
        small = parted.join(full, NAMES, "left_anti")
        dealt = small.select(*NAMES, "word", "n").repartition(*NAMES).sortWithinPartitions(*NAMES)
        near = dealt.mapInPandas(near_in_partitions, "word string, n_near bigint, best_n bigint, best string")
        found = near if found is None else found.unionByName(near)
        if full.isEmpty():
            break
        todo = parted.join(full, NAMES, "left_semi").drop("context")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("form")))
    whole = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return whole.select("word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of rows (word, form): the last word that forms lead to. Pointers are doubled until none moves."""
    leads = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        beyond = leads.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        moved = leads.join(beyond, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved"))
        moved = materialize(moved, "spelling-roots")
        leads = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return leads


def variants(counts: DataFrame, least_length: int = 5, least_n: int = 3, times: int = 2, group_words: int = GROUP_WORDS) -> DataFrame:
    """Per word of (word, n) of that length and count: word, form, root, n, n_near, form_n.

    The form is the near word of greatest n, if that is `times` the word's n at least; the root is where forms lead in the end.
    """
    vocabulary = materialize(counts.where((F.char_length("word") >= least_length) & (F.col("n") >= least_n)), "spelling-words")
    near = vocabulary.join(near_words(vocabulary, group_words), "word", "left")
    judged = near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), *(F.when(F.col("form_n") >= times * F.col("n"), F.col(c)).alias(c) for c in ("form", "form_n")))
    judged = materialize(judged, "spelling-forms")
    ends = roots(judged.where("form is not null"))
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

"""MinHash near-dedup with an LSH forest: several sorted orders of the signatures, neighbours in them as candidates.

A document's set is its distinct runs of `shingle` words. Documents with equal sets form one class and go on as one.
Each tree of the forest is the list of all classes sorted by a part of the signature of its own, continued by the other parts.
Classes that agree in the first `least_depth` values of a tree form a region of it.

1. Neighbours in an order, who have the longest common prefix, are compared on their full sets, and links join them to
   components: first in some trees, then in the others where neighbours are not in one component by then. So a large
   group of near copies is joined by a few comparisons per class.
2. Within each region only members of different components are left to compare. If those pairs are at most `width` times
   the members, all of them are compared. The members of fuller regions are joined exactly: two sets of the similarity
   share one of their rarest shingles, the smaller one among fewer of them (a prefix filter), so pairs that share one
   and can still reach the similarity from there on are compared, and no other can be a link.

The number of trees follows from the similarity (20 for 0.85, 29 for 0.80): two classes that have it share a region in at
least one of them but for a chance of 1e-5; no other pair is missed.
Nothing is dropped for size: groups of equal texts are aggregated before any shuffle of them, regions are split over tasks
by range, and no task holds a region.

Edge cases: NULL, empty and blank texts have no set and are components of their own. A text of fewer words than a shingle is one shingle.
Rows with one id are one node; if their texts differ it has the sets of all of them. NULL ids come first and are one node.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeops.llm.components import components
from lakeops.llm.hashing import Words, factors, mixed, runs
from lakeops.llm.ranges import known_key, real_key
from lakeops.session import materialize, materialize_small, small_batches

VALUE_BYTES = 2
#: Characters of text whose words are held at once.
STRETCH_CHARS = 2_000_000


class Shape:
    """Sizes of a forest: `trees` orders, each beginning with `least_depth` values of its own and `deepest` values long."""

    def __init__(self, trees: int = 20, least_depth: int = 5, deepest: int = 12, width: int = 16, first_trees: int = 3):
        self.trees, self.least_depth, self.deepest, self.width, self.first_trees = trees, least_depth, deepest, width, first_trees
        self.values = trees * least_depth
        self.by = factors(self.values, 200)

    @classmethod
    def reaching(cls, percent: int, miss: float = 1e-5, most_values: int = 200) -> Shape:
        """With as many trees as two sets of the similarity need to share a region but for a chance of `miss`."""
        for depth in range(5, 0, -1):
            alone = 1 - (percent / 100) ** depth
            trees = max(3, math.ceil(math.log(miss) / math.log(alone))) if alone > 0 else 3
            if trees * depth <= most_values or depth == 1:
                return cls(trees, depth, min(12, trees * depth))


def stretches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of the batches in stretches of some `STRETCH_CHARS` of text, one row at least."""
    for b in batches:
        ends = np.cumsum(b["text"].str.len().to_numpy(np.int64))
        for _, some in b.groupby(ends // STRETCH_CHARS):
            yield some


def shingle_sets(texts: list[bytes], shingle: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the runs of `shingle` lower-case words of each text."""
    words = Words(texts, lower=True)
    hashed = runs(words.hashes, shingle)
    out = []
    for s, e in zip(words.starts[:-1], words.starts[1:], strict=True):
        if e - s >= shingle:
            out.append(np.unique(hashed[s : e - shingle + 1]))
        else:
            out.append(runs(words.hashes[s:e], int(e - s)) ^ np.uint64(e - s) if e > s else np.empty(0, np.uint64))
    return out


def signature(hashes: np.ndarray, by: np.ndarray) -> bytes:
    """MinHash values, cut to 16 bits, in big-endian order so that bytes sort as values do."""
    least = np.full(len(by), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(hashes), 2048):
        np.minimum(least, (hashes[k : k + 2048, None] * by[None, :]).min(axis=0), out=least)
    return (mixed(least) >> np.uint64(48)).astype(">u2").tobytes()


def signatures(documents: DataFrame, shingle: int, shape: Shape, id_col: str, text_col: str) -> DataFrame:
    """(doc, n, set_key, signature) of every document; the key tells sets apart by 128 bits."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in stretches(batches):
            sets = shingle_sets([t.encode() for t in b["text"]], shingle)
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pd.DataFrame({"doc": b["doc"], "n": [len(s) for s in sets], "set_key": keys, "signature": [signature(s, shape.by) if len(s) else None for s in sets]})

    docs = documents.select(known_key(F.col(id_col)).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return docs.mapInPandas(sign, "doc bigint, n bigint, set_key binary, signature binary")


def orders(classes: DataFrame, shape: Shape) -> DataFrame:
    """(tree, key, node, n): each class once per tree, with the values by which the tree sorts it."""
    whole = F.concat("signature", "signature")
    step, size = shape.least_depth * VALUE_BYTES, shape.deepest * VALUE_BYTES
    keys = F.transform(F.sequence(F.lit(0), F.lit(shape.trees - 1)), lambda t: F.struct(t.alias("tree"), F.substring(whole, t * step + 1, F.lit(size)).alias("key")))
    return classes.select("node", "n", F.explode(keys).alias("at")).select("at.tree", "at.key", "node", "n")


def common_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading values that two arrays of keys (as rows of bytes) have in common."""
    same = (a == b).reshape(len(a), -1, VALUE_BYTES).all(axis=2)
    return np.where(same.all(axis=1), same.shape[1], np.argmin(same, axis=1))


def neighbours(ordered: DataFrame, shape: Shape) -> DataFrame:
    """Streams the sorted orders: per row, its common prefix with the row before it, and that row.

    Kept are rows that share the least depth with the row before or behind them, and the first and last of each range,
    whose neighbours may be in another one.
    """
    size = shape.deepest * VALUE_BYTES

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seq, held = TaskContext.get().partitionId(), 0, None
        for b in batches:
            if not len(b):
                continue
            keys = np.frombuffer(b"".join(b["key"]), np.uint8).reshape(len(b), size)
            columns = (keys, b["tree"].to_numpy(), b["node"].to_numpy(), b["n"].to_numpy())
            last = [c[:1] for c in columns] if held is None else [np.frombuffer(held["key"].iloc[0], np.uint8)[None, :], *[held[c].to_numpy() for c in ("tree", "node", "n")]]
            before = [np.concatenate([x, y[:-1]]) for x, y in zip(last, columns, strict=True)]
            shared = np.where(before[1] == columns[1], common_values(before[0], keys), 0)
            if held is None:
                shared[0] = -1
            rows = pd.DataFrame({"range": part, "seq": np.arange(seq, seq + len(b)), "tree": columns[1], "key": b["key"], "node": columns[2], "n": columns[3], "shared": shared.astype(np.int32), "before": before[2], "before_n": before[3]})
            seq += len(b)
            rows = rows if held is None else pd.concat([held, rows], ignore_index=True)
            near = rows["shared"].to_numpy() >= shape.least_depth
            keep = near[:-1] | near[1:] | (rows["seq"].to_numpy()[:-1] == 0)
            yield rows[:-1][keep]
            held = rows[-1:]
        if held is not None:
            yield held

    return ordered.mapInPandas(stream, "range int, seq bigint, tree int, key binary, node bigint, n bigint, shared int, before bigint, before_n bigint")


def sorted_orders(classes: DataFrame, shape: Shape) -> DataFrame:
    """All orders by range, with each row's neighbour, over the edges of ranges too; only rows that may have company."""
    dealt = orders(classes, shape).repartitionByRange("tree", "key", "node").sortWithinPartitions("tree", "key", "node")
    rows = materialize(neighbours(dealt, shape), "forest-orders")
    # one row per range: its first, joined to the last of the range before
    firsts = rows.where("seq = 0").select("range", "tree", "key", "node", "n")
    lasts = rows.groupBy("range").agg(F.max_by(F.struct("tree", "key", "node", "n"), "seq").alias("last"))
    edges = firsts.join(lasts, "range").withColumn("before", F.lag("last").over(W.orderBy("range")))
    same = lambda k: F.substring("key", 1, k * VALUE_BYTES) == F.substring(F.col("before.key"), F.lit(1), F.lit(k * VALUE_BYTES))
    depth = sum((F.when(same(k), 1).otherwise(0) for k in range(1, shape.deepest + 1)), F.lit(0))
    depth = F.when(F.col("before").isNotNull() & (F.col("before.tree") == F.col("tree")), depth).otherwise(0)
    edges = edges.select("range", F.lit(0).cast("long").alias("seq"), depth.alias("edge_shared"), F.col("before.node").alias("edge_before"), F.col("before.n").alias("edge_n"))
    joined = rows.join(F.broadcast(edges), ["range", "seq"], "left")
    return joined.select("tree", "key", "node", "n", F.coalesce("edge_shared", "shared").alias("shared"), F.coalesce("edge_before", "before").alias("before"), F.coalesce("edge_n", "before_n").alias("before_n"))


def may_link(n: str, m: str, percent: int):
    """Sets so different in size that they cannot reach the similarity are not compared."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have the similarity; both sets come by joins, so a hot class is split by its partners."""

    def compare(a: pd.Series, b: pd.Series) -> pd.Series:
        def one(x: bytes, y: bytes) -> bool:
            p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            common = len(np.intersect1d(p, q, assume_unique=True))
            return 100 * common >= percent * (len(p) + len(q) - common)

        return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype=bool)

    check = F.pandas_udf(compare, "boolean")
    x = sets.select(F.col("node").alias("a"), F.col("hashes").alias("set_a"))
    y = sets.select(F.col("node").alias("b"), F.col("hashes").alias("set_b"))
    return pairs.join(x, "a").join(y, "b").where(check("set_a", "set_b")).select("a", "b")


def ordered_pair(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def near_duplicates(documents: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", shape: Shape | None = None) -> DataFrame:
    """Per document: doc_id, n_shingles, class_id (least id with an equal set), component_id (least id reachable), kept."""
    with small_batches(documents.sparkSession):
        return grouped(documents, shingle, percent, id_col, text_col, shape or Shape.reaching(percent))


def grouped(documents: DataFrame, shingle: int, percent: int, id_col: str, text_col: str, shape: Shape) -> DataFrame:
    """The rows of `near_duplicates`; all that Python works on is written when this is called."""
    signed = materialize(signatures(documents, shingle, shape, id_col, text_col), "forest-signatures")
    filled = signed.where("n > 0").withColumn("node", F.xxhash64("set_key"))
    # one row per class: its node in the graph, its least document, and that document's signature
    classes = materialize(filled.groupBy("set_key", "node").agg(F.min("doc").alias("doc"), F.first("n").alias("n"), F.first("signature").alias("signature")), "forest-classes")
    forest = materialize(sorted_orders(classes, shape), "forest-neighbours")

    near = forest.where(F.col("shared") >= shape.least_depth)
    company = materialize_small(near.select("node").union(near.select("before")).distinct(), "forest-company")
    sets = materialize(full_sets(documents, classes.join(company, "node", "left_semi"), shingle, id_col, text_col), "forest-sets")
    adjacent = near.where(may_link("n", "before_n", percent)).select("tree", *ordered_pair("node", "before"))
    tested = materialize_small(adjacent.where(F.col("tree") < shape.first_trees).select("a", "b").distinct(), "forest-pairs")
    links = materialize_small(linked(tested, sets, percent), "forest-links").unionByName(classes_of_one_id(filled))
    joined = components(links)
    more = materialize_small(apart(adjacent.where(F.col("tree") >= shape.first_trees).select("a", "b").distinct(), joined), "forest-pairs")
    if not more.isEmpty():
        links = links.unionByName(materialize_small(linked(more, sets, percent), "forest-links"))
        tested, joined = tested.unionByName(more), components(links)
    rows = forest.join(company, "node", "left_semi").select("tree", "key", "node", "n")
    # all pairs of different components that share a region are settled here, so a second round would find none
    pairs = materialize_small(cross_pairs(rows, joined, sets, shape, percent).join(tested, ["a", "b"], "left_anti"), "forest-pairs")
    if not pairs.isEmpty():
        links = links.unionByName(materialize_small(linked(pairs, sets, percent), "forest-links"))
        joined = components(links)
    return named(signed, filled, joined)


def apart(pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """The pairs (a, b) that are not in one component yet."""
    a = joined.select(F.col("node").alias("a"), F.col("component").alias("component_a"))
    b = joined.select(F.col("node").alias("b"), F.col("component").alias("component_b"))
    same = F.coalesce("component_a", "a") == F.coalesce("component_b", "b")
    return pairs.join(a, "a", "left").join(b, "b", "left").where(~same).select("a", "b")


def classes_of_one_id(filled: DataFrame) -> DataFrame:
    """Links between the classes of rows that share an id but not the text."""
    ids = filled.groupBy("doc").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a != b").select("doc", "a")
    return filled.join(ids, "doc").where("node != a").select("a", F.col("node").alias("b")).distinct()


def full_sets(documents: DataFrame, classes: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """(node, hashes): the full set of each given class, from the text of its least document."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in stretches(batches):
            sets = shingle_sets([t.encode() for t in b["text"]], shingle)
            same = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() == k for x, k in zip(sets, b["set_key"], strict=True)]
            yield pd.DataFrame({"node": b["node"], "hashes": [x.tobytes() for x in sets]})[same]

    docs = documents.select(known_key(F.col(id_col)).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    built = docs.join(classes.select("doc", "node", "set_key"), "doc").select("node", "set_key", "text")
    return built.mapInPandas(build, "node bigint, hashes binary").dropDuplicates(["node"])


def cross_pairs(rows: DataFrame, joined: DataFrame, sets: DataFrame, shape: Shape, percent: int) -> DataFrame:
    """Pairs of classes of different components in one region: all of them, or of full regions those that may be links."""
    rows = rows.join(joined.select("node", "component"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    rows = rows.withColumn("region", F.substring("key", 1, shape.least_depth * VALUE_BYTES))
    sizes = rows.groupBy("tree", "region", "component").agg(F.count("*").alias("m"))
    sizes = sizes.groupBy("tree", "region").agg(F.sum("m").alias("members"), F.sum(F.col("m") * F.col("m")).alias("inside"), F.count("*").alias("parts"), F.max_by("component", F.struct("m", "component")).alias("main"))
    sizes = sizes.where("parts > 1").withColumn("fits", (F.col("members") * F.col("members") - F.col("inside")) / 2 <= shape.width * F.col("members"))
    rows = materialize_small(rows.join(sizes.select("tree", "region", "fits", "main"), ["tree", "region"]), "forest-regions")
    few = rows.where("fits")
    # one of each pair is outside the region's largest component, so a joined region is gone through for the others only
    left = few.where("component != main").select("tree", "region", "node", "n", "component")
    right = few.select("tree", "region", F.col("node").alias("other"), F.col("n").alias("other_n"), F.col("component").alias("other_component"))
    pairs = left.join(right, ["tree", "region"]).where((F.col("component") != F.col("other_component")) & may_link("n", "other_n", percent))
    pairs = pairs.select(*ordered_pair("node", "other"))
    full = materialize_small(rows.where("NOT fits").groupBy("node", "component").agg(F.max(F.col("component") != F.col("main")).alias("outside")), "forest-full")
    return (pairs if full.isEmpty() else pairs.unionByName(prefix_pairs(full, sets, percent))).distinct()


def shingle_rows(sets: DataFrame) -> DataFrame:
    """(node, component, outside, n, shingle): one row per shingle of each set."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for node, component, outside, raw in zip(b["node"], b["component"], b["outside"], b["hashes"], strict=True):
                shingles = np.frombuffer(raw, np.int64)
                yield pd.DataFrame({"node": node, "component": component, "outside": outside, "n": len(shingles), "shingle": shingles})

    return sets.mapInPandas(rows, "node bigint, component bigint, outside boolean, n bigint, shingle bigint")


def prefix_pairs(full: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components, one of them `outside`, that share a shingle early enough to reach the similarity.

    A set's shingles are put in one order for all sets: first those of one component only, which no pair to be found
    shares, then by the number of sets that have them. Of two sets of n and m >= n shingles with the similarity, c of them
    common, 100 * c >= percent * (n + m - c). So c is n * 2 * percent / (100 + percent) at least and m * percent / 100 at least,
    the smaller one has a common shingle among its first n - c + 1 and the larger one among its first m - c + 1, and from the
    first common one on both must have enough left. Sizes and places are conditions of the join, so no other pair comes out.
    """
    shingles = shingle_rows(full.join(sets, "node"))
    common = shingles.groupBy("shingle").agg(F.count("*").alias("found"), F.min("component").alias("least"), F.max("component").alias("most")).where("least != most").select("shingle", "found")
    ranked = shingles.join(common, "shingle").groupBy("node", "component", "outside", "n").agg(F.sort_array(F.collect_list(F.struct("found", "shingle"))).alias("ranked"))
    own = F.col("n") - F.size("ranked")
    length = F.col("n") - F.ceil(F.col("n") * percent / F.lit(100)) + 1 - own
    early = ranked.withColumn("own", own).where(length > 0).select("node", "component", "outside", "n", "own", F.posexplode(F.slice("ranked", F.lit(1), length.cast("int"))).alias("k", "at"))
    early = materialize(early.select("node", "component", "outside", "n", (F.col("own") + F.col("k")).alias("place"), F.col("at.shingle").alias("shingle")), "forest-prefixes")
    least = F.ceil(F.col("n") * 2 * percent / F.lit(100 + percent))  # common shingles with a set as large or larger
    small = early.where(F.col("place") <= F.col("n") - least)
    right = early.select("shingle", F.col("component").alias("other_component"), F.col("node").alias("other"), F.col("n").alias("other_n"), F.col("place").alias("other_place"), F.col("outside").alias("other_outside"))
    rest = F.least(F.col("n") - F.col("place"), F.col("other_n") - F.col("other_place"))
    larger = (F.col("n") < F.col("other_n")) | (F.col("n") == F.col("other_n")) & (F.col("node") < F.col("other"))
    may = larger & may_link("n", "other_n", percent) & (rest * (100 + percent) >= percent * (F.col("n") + F.col("other_n"))) & (F.col("component") != F.col("other_component"))
    # one of each pair is outside; of two that are not, none is brought together
    ways = [(small.where("outside"), right), (small.where("NOT outside"), right.where("other_outside"))]
    found = [x.join(y, (x["shingle"] == y["shingle"]) & may).select(*ordered_pair("node", "other")) for x, y in ways]
    return found[0].unionByName(found[1])


def named(signed: DataFrame, filled: DataFrame, joined: DataFrame) -> DataFrame:
    """Components of classes turned into components of documents, named by their least document."""
    rows = filled.select("doc", "node").distinct().join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = rows.groupBy("component").agg(F.min("doc").alias("component_id"))
    first = filled.groupBy("node").agg(F.min("doc").alias("class_id"))
    per_doc = rows.join(least, "component").join(first, "node").groupBy("doc").agg(F.min("component_id").alias("component_id"), F.min("class_id").alias("class_id"))
    docs = signed.select("doc", F.col("n").alias("n_shingles")).join(per_doc, "doc", "left")
    component, own = F.coalesce("component_id", "doc"), F.coalesce("class_id", "doc")
    return docs.select(real_key(F.col("doc")).alias("doc_id"), "n_shingles", real_key(own).alias("class_id"), real_key(component).alias("component_id"), (component == F.col("doc")).alias("kept"))


def unique_documents(documents: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", shape: Shape | None = None) -> DataFrame:
    """One document of each group, with its own columns only: the one of least id, or without ids the first row.

    Every row is a node of its own here, found again by a row number written with the documents.
    """
    row = "_forest_row"
    while row in [c.lower() for c in documents.columns]:
        row += "_"
    rows = materialize(documents.withColumn(row, F.monotonically_increasing_id()), "forest-documents")
    groups = near_duplicates(rows, shingle, percent, row, text_col, shape).select(F.col("doc_id").alias(row), "component_id")
    least = groups.join(rows.select(row, F.col(id_col).alias("_id")), row).groupBy("component_id").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", row))[row].alias(row))
    return rows.join(least.select(row), row, "left_semi").select(*documents.columns)

"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are put in a random order that depends on the key only. A document's virtual finish time is the
number of its source's tokens up to and including it, divided by the source's target; a further pass over the source
adds the whole source again. Sorting all documents of all passes by that time serves the sources in proportion to
their targets at every moment, and the mix is the longest prefix that stays within the token budget.

No source, however large, is sorted in one task: documents fall into blocks of their hash, the blocks are summed first,
and only documents of one block are ordered together. The global order is a range partitioning with one running total per
partition; only the partitions' totals meet in one place.

Edge cases: NULL text has size 0, NULL source is a source of its own that comes last. Documents of size 0 are taken, as
nothing. Repeated rows are documents of their own. An empty table gives an empty result. Columns of the documents with
the names used here do not matter: only the key, text and source are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeops.llm.words import word_count
from lakeops.session import materialize


def source_targets(sizes: DataFrame, max_repeat: int = 3, cycle: int = 3) -> DataFrame:
    """One row per source of `sizes` (source, size): source_size, target.

    Sources in code-point order, NULL last, weigh 1 to `cycle`, repeating. A target stops at `max_repeat` times the size;
    what it leaves is shared by weight among the others. In order of size / weight the sources that stop come first,
    so how many stop is read off running sums, without a loop. There is one row per source here, not per document.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    by = by.withColumn("weight", F.pmod(place - 1, F.lit(cycle)) + 1)
    order = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    whole = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    left = F.sum("source_size").over(whole) - max_repeat * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    shared = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    by = by.withColumn("left", left).withColumn("shared", shared)
    # the share of this source if all before it stop and none from it on
    by = by.withColumn("stops", F.col("weight") * F.col("left") > max_repeat * F.col("source_size") * F.col("shared"))
    n_stop = F.sum(F.col("stops").cast("int")).over(whole)
    at = F.row_number().over(order)
    by = by.withColumn("n_stop", n_stop).withColumn("at", at)
    rest = F.struct("left", "shared")
    by = by.withColumn("rest", F.max(F.when(F.col("at") == F.col("n_stop") + 1, rest)).over(whole))
    share = F.col("weight") * F.col("rest.left") / F.col("rest.shared")
    target = F.when(F.col("at") <= F.col("n_stop"), (max_repeat * F.col("source_size")).cast("double")).otherwise(share)
    return by.select("source", "source_size", target.alias("target"))


def shuffle_key(key: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit("null"))))


def mix(documents: DataFrame, max_repeat: int = 3, seed: str = "mix:", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block_rows: int = 5_000, row_col: str | None = None) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, `passes` (how often the mix takes it) and taken, the
    words it gives the mix. `row_col` names a column that tells rows apart; it is kept as `row`.

    The sizes are written to the scratch folder first, so the texts are read once.
    """
    row = [F.col(row_col).alias("row")] if row_col else []
    key = F.struct(F.col("source").isNull().alias("none"), F.coalesce(F.col("source"), F.lit("")).alias("name"))
    columns = [F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")]
    docs = materialize(documents.select(*columns, *row, shuffle_key(F.col(id_col), seed).alias("h")), "mix-sizes").withColumn("key", key)
    targets = source_targets(docs, max_repeat).withColumn("key", key).drop("source")
    budget, rows = docs.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()

    # the order within a source: blocks of the hash, then rows of one block
    n_blocks = max(1, rows // block_rows)
    block = F.shiftright(F.conv(F.substring("h", 1, 8), 16, 10).cast("long") * n_blocks, 32)
    docs = docs.withColumn("block", block)
    blocks = docs.groupBy("key", "block").agg(F.sum("size").alias("block_size"))
    before = W.partitionBy("key").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select("key", "block", F.coalesce(F.sum("block_size").over(before), F.lit(0)).alias("earlier"))
    within = W.partitionBy("key", "block").orderBy("h", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    docs = docs.withColumn("inner", F.sum("size").over(within)).join(blocks, ["key", "block"]).join(targets, "key")
    docs = docs.withColumn("upto", F.col("earlier") + F.col("inner")).drop("key", "block", "earlier", "inner")
    docs = materialize(docs, "mix-placed")

    cut = first_beyond(docs, budget, max_repeat, max(1, rows * max_repeat // 50_000))
    if cut is None:
        passes = F.lit(max_repeat)
    else:
        end = F.struct(*[F.lit(x) for x in cut])
        passes = sum((F.when(service(k) < end, 1).otherwise(0) for k in range(max_repeat)), F.lit(0))
    passes = F.when(F.col("size") > 0, passes).otherwise(1)
    return docs.withColumn("passes", passes).withColumn("taken", F.col("size") * F.col("passes")).drop("h", "upto")


def service(k: int) -> Column:
    """Place of a document's pass `k` in the mix: virtual finish time, then hash and pass."""
    finish = (k * F.col("source_size") + F.col("upto")) / F.col("target")
    return F.struct(finish.alias("finish"), F.col("h").alias("h"), F.lit(k).alias("pass"))


def first_beyond(docs: DataFrame, budget: int, max_repeat: int, ranges: int) -> tuple | None:
    """Place of the first document that the budget has no room for; None if all passes fit.

    All passes are sorted over range partitions, whose number follows the rows; totals of the partitions tell in which one the budget ends, and only
    that one is summed up row by row.
    """
    served = docs.where("size > 0").select("size", F.explode(F.array(*[service(k) for k in range(max_repeat)])).alias("at"))
    served = served.repartitionByRange(ranges, "at.finish", "at.h", "at.pass").sortWithinPartitions("at.finish", "at.h", "at.pass")
    served = materialize(served.select(F.spark_partition_id().alias("part"), "size", "at"), "mix-order")
    totals = served.groupBy("part").agg(F.sum("size").alias("total"))
    upto = totals.select("part", F.sum("total").over(W.orderBy("part")).alias("upto"), "total")
    found = upto.where(F.col("upto") > budget).orderBy("part").first()
    if found is None:
        return None
    running = F.sum("size").over(W.orderBy("at").rowsBetween(W.unboundedPreceding, 0)) + (found["upto"] - found["total"])
    row = served.where(F.col("part") == found["part"]).select("at", running.alias("running")).where(F.col("running") > budget).orderBy("at").first()
    return tuple(row["at"])


def mixed_documents(documents: DataFrame, max_repeat: int = 3, seed: str = "mix:", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: every document as often as `mix` takes it, with its own columns only.

    The documents are written to the scratch folder with a row number, by which the decisions find them again; so
    documents may share a key or have none.
    """
    name = "_mix_row"
    while any(c.lower().startswith(name) for c in documents.columns):
        name += "_"
    rows = materialize(documents.withColumn(name, F.monotonically_increasing_id()), "mix-documents")
    plan = mix(rows, max_repeat, seed, id_col, text_col, source_col, row_col=name).where("passes > 0").select(F.col("row").alias(name), F.col("passes").alias(f"{name}_n"))
    out = rows.join(plan, name)
    return out.withColumn(f"{name}_n", F.explode(F.sequence(F.lit(1), f"{name}_n"))).select(*documents.columns)

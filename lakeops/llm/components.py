"""Connected components of a graph given as rows of edges, by contraction.

Each round every component points to the least of its neighbours and itself, and follows the pointers some steps on; edges
are renamed by where they lead and made distinct. A chain shrinks threefold a round, a star is done in one, so rounds are few. All
steps are joins and aggregates with one row per node on one side; each round is written to the scratch folder, so lineage
stays short and a lost executor costs little.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.session import materialize_small

JUMPS = 2


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of edges (a, b); the component is its least node."""
    edges = edges.select("a", "b").where("a != b")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = materialize_small(both.distinct(), "component-links")
    labels = None
    while not links.isEmpty():
        parents = materialize_small(links.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("parent")), "component-parents")
        up = parents.select(F.col("a").alias("parent"), F.col("parent").alias("grand"))
        for _ in range(JUMPS):
            parents = parents.join(up, "parent").select("a", F.col("grand").alias("parent"))
        parents = materialize_small(parents, "component-parents")
        if labels is None:
            labels = parents.select(F.col("a").alias("node"), F.col("parent").alias("component"))
        else:
            named = parents.select(F.col("a").alias("component"), F.col("parent").alias("new"))
            labels = labels.join(named, "component", "left").select("node", F.coalesce("new", "component").alias("component"))
            labels = materialize_small(labels, "component-labels")
        a = parents.select("a", F.col("parent").alias("na"))
        b = parents.select(F.col("a").alias("b"), F.col("parent").alias("nb"))
        links = links.join(a, "a").join(b, "b").where("na != nb").select(F.col("na").alias("a"), F.col("nb").alias("b")).distinct()
        links = materialize_small(links, "component-links")
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels

"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackflow.llm.shared import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of edges (a, b); root is the component's smallest node.

    Large and small stars in turn (Kiveris et al.): every node's larger neighbours, then the smaller
    ones, are linked to its smallest neighbour, until all components are stars. Neighbours are never
    gathered, only their minimum is, and each round is written to the shared folder."""
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(edges.distinct(), "edges")
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(small.union(least).distinct(), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select("b", "b").distinct())


def forest_roots(links: DataFrame) -> DataFrame:
    """(node, root) of every node of links (a, b) in which each a has one b and there is no cycle.

    Pointers are doubled until every one leads to a root, so a path of n links takes log2 n rounds."""
    up = stored(links.select(F.col("a").alias("node"), F.col("b").alias("root")), "forest")
    while True:
        on = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
        far = up.join(on, "root", "left").select("node", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        far = stored(far, "forest")
        up = far.drop("moved")
        if far.where("moved").isEmpty():
            return up.union(up.select("root", "root").distinct())

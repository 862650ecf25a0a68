"""Connected components of a table of links, by contraction; nothing is collected on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for each node of the links; the root is the smallest node of its component.

    Each round gives a node the first of itself and its neighbours in an order drawn anew, jumps to that one's choice and
    contracts the links; the links left shrink by a share with every round until none is left.  In the order of the nodes
    themselves a chain numbered along its length would shrink by two a round.  The rounds' jumps are written and put
    together from the last one, the shortest, back to the first; the smallest node is found at the end.
    """
    edges = written(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "graph-edges")
    jumps = []
    while not edges.isEmpty():
        drawn = lambda c, i=len(jumps): F.xxhash64(c, F.lit(i))
        ends = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        parent = ends.groupBy("u").agg(F.min_by("v", drawn("v")).alias("v")).select("u", F.when(drawn("v") < drawn("u"), F.col("v")).otherwise(F.col("u")).alias("p"))
        jump = written(parent.alias("x").join(parent.alias("y"), F.col("x.p") == F.col("y.u")).select(F.col("x.u").alias("u"), F.col("y.p").alias("p")), "graph-jumps")
        jumps.append(jump)
        moved = edges.join(jump.select(F.col("u").alias("a"), F.col("p").alias("pa")), "a").join(jump.select(F.col("u").alias("b"), F.col("p").alias("pb")), "b")
        edges = written(moved.where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "graph-edges")
    if not jumps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    to = jumps.pop()
    for jump in reversed(jumps):
        to = jump.join(to.select(F.col("u").alias("p"), F.col("p").alias("_to")), "p", "left").select("u", F.coalesce("_to", "p").alias("p"))
    to = written(to, "graph-ends")
    least = to.groupBy("p").agg(F.min("u").alias("root"))
    return written(to.join(least, "p").select(F.col("u").alias("node"), "root"), "graph-labels")


def extend(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after further links: only the roots that the new links join are contracted."""
    root = lambda c: labels.select(F.col("node").alias(c), F.col("root").alias(f"r{c}"))
    new = links.select("a", "b").join(root("a"), "a", "left").join(root("b"), "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    over = components(new)
    old = labels.join(over.select(F.col("node").alias("root"), F.col("root").alias("_to")), "root", "left").select("node", F.coalesce("_to", "root").alias("root"))
    return written(old.unionByName(over.join(labels.select("node"), "node", "left_anti")), "graph-labels")

"""Connected components of a graph given as edges, in DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _stars(edges: DataFrame, up: bool) -> DataFrame:
    """Hang each node's larger (or other smaller) neighbours on its smallest one.

    The least neighbour is a partial aggregate and comes back by a join, so that a
    node with very many neighbours is never one task's work.
    """
    if up:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        out = both.where("b > a").join(least, "a").select(F.col("b").alias("b"), F.col("m").alias("a"))
    else:  # a: larger end, b: smaller end
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        out = down.join(least, "a").select(F.explode(F.array("a", "b")).alias("b"), F.col("m").alias("a"))
    return out.where("a <> b").select("a", "b").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, component)`` for each node of the edges ``(a, b)``; a component is
    named by its smallest node. Loops and repeated edges do no harm; no edges give
    no rows. Alternates large-star and small-star rounds until every node hangs on
    its component's smallest node; each round is written to the shared folder. Only
    a count and a checksum of the edges reach the driver.
    """
    now = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), name)
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark or not seen[0]:
            break
        mark = tuple(seen)
        now = written(_stars(_stars(now, up=True), up=False), name)
    leaves = now.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return leaves.unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())

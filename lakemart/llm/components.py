"""Connected components of a graph given as edges, by alternating large and small stars.

Every round is a few grouped minima and joins over the edges, written to the shared
folder; a hot node is a hot key of a join that adaptive execution splits. The number
of rounds grows with the logarithm of the largest component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them; edges point from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node id reachable, for every node that is not its own component."""
    now = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(),
                 "edges")
    seen = _state(now)
    while seen[0]:
        now = staged(_small_star(_large_star(now).where("a != b")), "edges")
        after = _state(now)
        if tuple(after) == tuple(seen):
            break
        seen = after
    return now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))

"""Connected components of a graph held as tables.

Every node points to a parent, at first itself. A round lets a node look at its neighbours'
grandparents: the least of them becomes a parent of the node and of the node's parent, and
chains of parents are halved. The number of rounds grows with the logarithm of the longest
path. A node with very many neighbours is a hot key of a join that adaptive execution
splits, and its minimum is folded before the shuffle. Each round is written to the shared
folder, so a lost executor repeats tasks of one round only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.session import work_dir
from lakemart.sinks.tables import write_table


def _written(df: DataFrame, name: str) -> DataFrame:
    return write_table(df, work_dir(df.sparkSession, "graph", f"{name}-{uuid.uuid4().hex}"))


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component) for ``nodes`` (node) and undirected ``edges`` (a, b) between them: the least node reachable."""
    both = _written(edges.where("a != b").select("a", "b").unionByName(
        edges.where("a != b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    parents = _written(nodes.select("node", F.col("node").alias("parent")).distinct(), "parents")
    seen = None
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        known = _written(parents.join(up, "parent"), "grand")
        state = tuple(known.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "grand").cast("decimal(38,0)"))).first())
        if state == seen:
            return known.select("node", F.col("grand").alias("component"))
        seen = state
        least = both.join(known.select(F.col("node").alias("b"), "grand"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("grand").alias("near"))
        offers = known.join(least, "node", "left").select(F.explode(F.array(
            F.struct("node", F.least("parent", "grand", "near").alias("parent")),
            F.struct(F.col("parent").alias("node"), F.coalesce("near", "parent").alias("parent")),
        )).alias("x")).select("x.*")
        parents = _written(offers.groupBy("node").agg(F.min("parent").alias("parent")), "parents")

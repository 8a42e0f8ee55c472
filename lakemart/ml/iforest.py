"""Isolation forest (Liu, Ting, Zhou 2008) over Spark.

Each tree learns from 256 rows, so training data stay at 25,600 rows whatever
the size of the table. Trees are built in parallel, one group each; scoring is
an Arrow batch function over the whole table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.ranks import exact_quantiles
from lakemart.session import shuffle_width

TREES = 100
SAMPLE = 256
NODE_COLUMNS = "tree int, node int, feature int, split double, left int, right int, length double"


def mean_path(n: float) -> float:
    """Average depth of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def _grow(values: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Nodes of one random tree as (feature, split, left, right, path length)."""
    nodes: list[list] = []

    def build(rows: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append([-1, 0.0, -1, -1, depth + mean_path(len(rows))])
        if depth >= limit or len(rows) <= 1:
            return me
        low, high = rows.min(axis=0), rows.max(axis=0)
        open_columns = np.flatnonzero(high > low)
        if len(open_columns) == 0:
            return me
        feature = int(rng.choice(open_columns))
        split = float(rng.uniform(low[feature], high[feature]))
        below = rows[:, feature] < split
        nodes[me][:2] = [feature, split]
        nodes[me][2] = build(rows[below], depth + 1)
        nodes[me][3] = build(rows[~below], depth + 1)
        return me

    build(values, 0)
    return [tuple(n) for n in nodes]


def train(df: DataFrame, columns: list[str], key: list[str], trees: int = TREES, sample: int = SAMPLE,
          seed: int = 42) -> DataFrame:
    """One row per tree node.

    Every tree draws about twice its sample from the whole table, by a hash of row and
    tree under a threshold, and keeps the first rows of its own hash order.
    """
    keyed = df.select(F.xxhash64(*key, F.lit(seed)).alias("h"), *[F.col(c).cast("double").alias(c) for c in columns])
    share = F.lit(2.0 * sample) / df.agg(F.count(F.lit(1))).scalar()

    def place(t):
        return F.shiftrightunsigned(F.xxhash64("h", t), 1) / float(1 << 63)

    drawn = keyed.withColumn("share", share).withColumn("tree", F.explode(F.filter(
        F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: place(t) < F.col("share")
    )))
    order = Window.partitionBy("tree").orderBy(F.xxhash64("h", "tree", F.lit(1)), "h", *columns)
    taken = drawn.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= sample)
    depth = math.ceil(math.log2(max(sample, 2)))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        rows = pdf.sort_values("rank")[columns].to_numpy(dtype=float)
        nodes = _grow(rows, np.random.default_rng([seed, tree]), depth)
        out = pd.DataFrame(nodes, columns=["feature", "split", "left", "right", "length"])
        out.insert(0, "node", range(len(out)))
        out.insert(0, "tree", tree)
        return out

    return taken.repartition(shuffle_width(df.sparkSession), "tree").groupBy("tree").applyInPandas(grow, NODE_COLUMNS)


def save(nodes: DataFrame, columns: list[str], path: str) -> None:
    """Keep a forest: its nodes and the columns they split on, in order."""
    nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    names = nodes.sparkSession.createDataFrame(list(enumerate(columns)), "place int, name string")
    names.coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")


def load(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """(nodes, columns) of a kept forest."""
    names = spark.read.parquet(f"{path}/columns").orderBy("place").collect()
    return spark.read.schema(NODE_COLUMNS).parquet(f"{path}/nodes"), [r["name"] for r in names]


def with_score(df: DataFrame, nodes: DataFrame, columns: list[str], out: str, rows_seen: int = SAMPLE) -> DataFrame:
    """Add the anomaly score in [-1, 0): lower is more anomalous.

    The forest is at most trees * 511 nodes, so it goes to the executors as a
    broadcast variable. A forest over one column is a step function of it: its scores between
    neighbouring splits are worked out once, and a row looks its own up.
    """
    table = nodes.orderBy("tree", "node").toPandas()
    forest = [
        (g["feature"].to_numpy(), g["split"].to_numpy(), g["left"].to_numpy(), g["right"].to_numpy(),
         g["length"].to_numpy())
        for _, g in table.groupby("tree")
    ]
    norm = mean_path(rows_seen) or 1.0

    def scores(trees: list[tuple], x: np.ndarray) -> np.ndarray:
        rows, total = np.arange(len(x)), np.zeros(len(x))
        for feature, split, left, right, length in trees:
            at = np.zeros(len(x), dtype=int)
            while True:
                inner = feature[at] >= 0
                if not inner.any():
                    break
                below = x[rows, np.maximum(feature[at], 0)] < split[at]
                at = np.where(inner, np.where(below, left[at], right[at]), at)
            total += length[at]
        return -np.power(2.0, -(total / len(trees)) / norm)

    if len(columns) == 1 and forest:
        # between two neighbouring splits all values take the same path in every tree; no number walks like the largest
        splits = np.unique(table.loc[table["feature"] >= 0, "split"].to_numpy())
        steps = scores(forest, np.concatenate([[-np.inf], splits])[:, None])
        held = df.sparkSession.sparkContext.broadcast((splits, steps))

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            at, known = held.value
            for batch in batches:
                yield pd.Series(known[np.searchsorted(at, batch.iloc[:, 0].to_numpy(dtype=float), side="right")])
    else:
        shared = df.sparkSession.sparkContext.broadcast(forest)

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series(scores(shared.value, batch.to_numpy(dtype=float)))

    udf = F.pandas_udf(_typed(score), T.DoubleType())
    return df.withColumn(out, udf(F.struct(*[F.col(c).cast("double").alias(c) for c in columns])))


def _typed(fn):
    """Attach the iterator type hints that select the batch flavour of the function."""
    fn.__annotations__ = {"batches": Iterator[pd.DataFrame], "return": Iterator[pd.Series]}
    return fn


def flag(scored: DataFrame, score: str, out: str, contamination: float = 0.1) -> DataFrame:
    """Mark rows whose score lies under the exact contamination quantile.

    ``scored`` should be a written table: the quantile scans it before the flag does.
    """
    cut = exact_quantiles(scored.select(score), score, [contamination]).select("q0").scalar()
    return scored.withColumn(out, F.col(score) < cut)

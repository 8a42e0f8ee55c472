"""A forest over one column scores by its steps, with the scores of the walk through its trees."""

import inspect

import numpy as np
from pyspark.sql import functions as F

from lakemart.ml import iforest


def test_one_column_scores_by_steps_as_by_trees(spark):
    rng = np.random.default_rng(4)
    values = [float(v) for v in np.round(rng.normal(50, 9, 800), 1)] + [0.0, -0.0, 900.0, None, float("nan"), float("inf"), float("-inf")]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, a double").repartition(3)
    nodes = iforest.train(rows.where("a BETWEEN 0 AND 900"), ["a"], ["id"], trees=20, sample=64)
    # splits are hit as well
    rows = rows.union(nodes.where("feature >= 0").select(F.lit(-1).cast("long"), "split")).withColumn("b", F.lit(1.0))
    by_steps = iforest.with_score(rows, nodes, ["a"], "s")
    by_trees = iforest.with_score(rows, nodes, ["a", "b"], "s")
    assert sorted(map(str, by_steps.collect())) == sorted(map(str, by_trees.collect()))
    assert "searchsorted" in inspect.getsource(iforest.with_score)

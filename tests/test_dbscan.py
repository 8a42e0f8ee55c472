"""Density clusters and graph components against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemart.functions.graph import components
from lakemart.ml import dbscan


def plain_dbscan(points: np.ndarray, eps: float, min_samples: int) -> list[int]:
    """Every row against every row; clusters in order of their first core row."""
    near = np.stack([((points - p) ** 2).sum(axis=1) <= eps * eps for p in points])
    core = near.sum(axis=1) >= min_samples
    labels, found = np.full(len(points), -1), 0
    for i in range(len(points)):
        if core[i] and labels[i] < 0:
            labels[i], open_ = found, [i]
            while open_:
                j = open_.pop()
                for k in np.flatnonzero(near[j] & (labels < 0)) if core[j] else ():
                    labels[k] = found
                    open_.append(k)
            found += 1
    return labels.tolist()


def rows_of(spark, points):
    names = [f"f{i}" for i in range(points.shape[1])]
    rows = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)],
                                 "id long, " + ", ".join(f"{n} double" for n in names))
    return rows.repartition(5), names


def labels_of(spark, points, eps, min_samples):
    rows, names = rows_of(spark, points)
    return [r.Segment for r in dbscan.labels(rows, "id", names, eps, min_samples).orderBy("id").collect()]


@pytest.mark.parametrize("d, n, eps, least", [(2, 500, .12, 5), (6, 300, 1.0, 5), (1, 250, .02, 4)])
def test_clusters_borders_and_noise(spark, d, n, eps, least):
    rng = np.random.default_rng(d)
    spread = [rng.normal(c, .35, (n // 3, d)) for c in (0, 1.2, 3)] + [rng.uniform(-1, 4, (n // 5, d))]
    points = np.round(np.concatenate(spread), 3)
    points = np.concatenate([points, np.repeat(points[:3], 20, axis=0)])      # equal rows
    rng.shuffle(points)
    expected = plain_dbscan(points, eps, least)
    assert -1 in expected and max(expected) > 0
    assert labels_of(spark, points, eps, least) == expected


def test_one_dense_cell_of_ten_thousand_rows(spark):
    rng = np.random.default_rng(7)
    hot = rng.uniform(0, .1, (10_000, 2))
    around = np.concatenate([rng.uniform(-1.5, 1.5, (300, 2)), [[.55, .05]], rng.uniform(2, 2.1, (40, 2))])
    points = np.concatenate([hot, around])
    rows, names = rows_of(spark, points)
    grid, cells = dbscan._grid(rows, names, "id", .5, 5)
    assert cells.agg(F.max("weight")).scalar() is not None and cells.orderBy(F.desc("weight")).first().weight >= 10_000
    # only points of sparse cells are compared: no row of the hot cell starts a comparison
    assert grid.where("dense").count() >= 10_000 and grid.where("NOT dense").count() <= 300
    assert labels_of(spark, points, .5, 5) == plain_dbscan(points, .5, 5)


def test_dense_cells_touch_by_their_closest_pair(spark):
    rng = np.random.default_rng(3)
    left = np.column_stack([rng.uniform(0, .1, 400), rng.uniform(0, .3, 400)])
    for gap, clusters in ((.495, 1), (.505, 2)):
        right = left + [0, 0]
        right[:, 0] = left[:, 0] + left[:, 0].max() - left[:, 0].min() + gap     # narrowest distance along x is gap
        points = np.concatenate([left, right])
        got = labels_of(spark, points, .5, 5)
        assert got == plain_dbscan(points, .5, 5)
        assert max(got) + 1 <= clusters


def test_odd_rows_and_no_rows(spark):
    rows = spark.createDataFrame([(1, 0.0, 1.0), (2, -0.0, 1.0), (3, 0.0, 1.0), (4, None, 1.0), (5, float("nan"), 1.0),
                                  (6, float("inf"), 0.0), (7, 9.0, 9.0)], "id long, a double, b double")
    got = {r.id: r.Segment for r in dbscan.labels(rows, "id", ["a", "b"], .5, 3).collect()}
    assert got == {1: 0, 2: 0, 3: 0, 4: -1, 5: -1, 6: -1, 7: -1}
    assert dbscan.labels(rows.limit(0), "id", ["a", "b"], .5, 3).collect() == []


def test_components_of_chains_stars_and_single_nodes(spark):
    rng = np.random.default_rng(2)
    names = rng.permutation(1200).tolist()
    chain = [(names[i], names[i + 1]) for i in range(499)]
    star = [(names[500], names[i]) for i in range(501, 1000)]
    pairs = [(names[i], names[i + 1]) for i in range(1000, 1100, 2)] + [(names[1150], names[1150])]
    nodes = spark.createDataFrame([(n,) for n in names], "node long")
    edges = spark.createDataFrame(chain + star + pairs + pairs, "a long, b long")
    expected = {n: n for n in names}
    for group in (names[:500], names[500:1000], *[names[i:i + 2] for i in range(1000, 1100, 2)]):
        expected.update({n: min(group) for n in group})
    assert {r.node: r.component for r in components(nodes, edges).collect()} == expected
    assert {r.node: r.component for r in components(nodes.limit(3), edges.limit(0)).collect().copy()}.keys() == {
        r.node for r in nodes.limit(3).collect()}

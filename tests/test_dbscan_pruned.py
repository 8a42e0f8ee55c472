"""What the density clusters leave to be compared point by point."""

import numpy as np

from lakemart.ml import dbscan


def test_dense_rows_leave_few_points_and_pairs_open(spark, monkeypatch):
    rng = np.random.default_rng(5)
    points = rng.uniform(0, 3, (4000, 3))
    rows = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "id long, a double, b double, c double")
    seen, write = {}, dbscan._written

    def counted(df, name):
        out = write(df, name)
        seen[name] = seen.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(dbscan, "_written", counted)
    got = {r.id: r.Segment for r in dbscan.labels(rows, "id", ["a", "b", "c"], .5, 5).collect()}
    assert set(got.values()) == {0}
    # all pairs within reach: about 4000 * 4000 * .5 / 27
    assert seen["contacts"] < 4000 and seen["pairs"] < 200

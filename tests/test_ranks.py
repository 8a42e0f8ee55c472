"""Ranks and quantiles against numpy, on few and many partitions and with skew."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakemart.functions.ranks import dense_key, exact_quantiles, running_total

SMALL = {"partitions": 7}


@pytest.mark.parametrize("options", [{}, SMALL])
def test_dense_key_is_the_row_number(spark, options):
    keys = [f"k{random.Random(3).randint(0, 10**9)}-{i}" for i in range(500)]
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(5)
    got = {r["k"]: r["id"] for r in dense_key(df, "k", "id", **options).collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(keys))}


def test_running_total_per_group(spark):
    rows = [(i % 3, i, i % 5) for i in range(600)]
    df = spark.createDataFrame(rows, "g int, k int, w int").repartition(6)
    got = {(r["g"], r["k"]): r["s"] for r in running_total(df, "k", "w", "s", ["g"], **SMALL).collect()}
    for g in range(3):
        total = 0
        for _, k, w in sorted(r for r in rows if r[0] == g):
            total += w
            assert got[(g, k)] == total


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=120), st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.9, 1.0]))
def test_quantile_equals_numpy(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = exact_quantiles(df, "v", [p], **SMALL).first()["q0"]
    assert got == pytest.approx(float(np.quantile(values, p)), abs=1e-9)


def test_quantile_with_one_value_holding_most_rows(spark):
    values = [7.0] * 2000 + [float(i) for i in range(300)] + [None] * 10
    df = spark.createDataFrame([("a" if i % 2 else "b", v) for i, v in enumerate(values)], "g string, v double")
    got = {r["g"]: (r["q0"], r["q1"]) for r in exact_quantiles(df, "v", [0.25, 0.95], ["g"], **SMALL).collect()}
    for g in "ab":
        mine = [v for i, v in enumerate(values) if v is not None and ("a" if i % 2 else "b") == g]
        assert got[g] == pytest.approx(tuple(np.quantile(mine, [0.25, 0.95])))


def _sent_to_the_driver(spark, df) -> int:
    """Bytes of task results that reach the driver when a frame is written to nowhere."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("sent", "bytes sent to the driver")
    try:
        df.write.format("noop").mode("overwrite").save()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = {s for job in tracker.getJobIdsForGroup("sent") for s in tracker.getJobInfo(job).stageIds}
    return sum(store.lastStageAttempt(s).resultSize() for s in stages if tracker.getStageInfo(s) is not None)


def test_ranks_of_many_partitions_send_little_to_the_driver(spark):
    df = spark.range(0, 300_000, 1, 400).selectExpr("concat('key', id * 7919 % 300000) AS k")
    keyed = dense_key(df, "k", "id", partitions=400)
    seen = keyed.selectExpr("count(*) AS n", "count(DISTINCT id) AS ids", "max(id) AS top").first()
    assert tuple(seen) == (300_000, 300_000, 300_000)
    # the offsets of 400 ranges, not the ranks of 300,000 rows: these alone are 2.4 MB
    assert 0 < _sent_to_the_driver(spark, keyed.select("id")) < 16 << 20


def test_null_groups_are_ranked(spark):
    df = spark.createDataFrame([(None, 2, 1), (None, 1, 1), ("a", 5, 1)], "g string, k int, w int")
    got = {(r["g"], r["k"]): r["s"] for r in running_total(df, "k", "w", "s", ["g"]).collect()}
    assert got == {(None, 1): 1, (None, 2): 2, ("a", 5): 1}


def test_small_spread_around_a_large_mean(spark):
    from lakemart.functions.columns import sample_std

    df = spark.range(1000).selectExpr("1e9D + (id % 2) * 0.01D AS v")
    assert df.agg(sample_std("v")).first()[0] == pytest.approx(0.0050025, rel=1e-3)

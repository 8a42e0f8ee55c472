"""Distinct counts by bitmaps against Spark's own, in one scan."""

import random

import pytest
from pyspark.sql import functions as F

from lakemart.functions import distinct
from lakemart.operators import analytics, kpi
from lakemart.plans.warehouse import open_warehouse

NAMES = {"a": "x", "b": "y"}


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(6)
    data = [(rng.choice([None, "g", "h"]), rng.choice([None, 0, 1, 32767, 32768, 65535, 65536, 70000, rng.randint(0, 70000)]),
             rng.randint(0, 40), 1) for _ in range(4000)]
    return spark.createDataFrame(data, "g string, x long, y long, w int").repartition(5)


@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("tops", [None, {"x": 70000}, {"x": 70000, "y": 40}])
def test_counts_with_and_without_bitmaps(rows, by, tops):
    got = distinct.aggregate(rows, by, [F.sum("w").alias("w")], NAMES, tops=tops)
    expected = rows.groupBy(*by).agg(F.sum("w").alias("w"), F.countDistinct("x").alias("a"), F.countDistinct("y").alias("b"))
    assert sorted(map(str, got.select(expected.columns).collect())) == sorted(map(str, expected.collect()))


def test_columns_beyond_the_bound_are_folded(rows):
    assert distinct._fitting({"x", "y"}, {"x": 70000, "y": 40}, 1) == ["y", "x"]
    assert distinct._fitting({"x", "y"}, {"x": 70000, "y": 40}, 10_000) == ["y"]
    assert distinct._fitting({"x", "y"}, {"x": 1 << 40, "y": 1 << 40}, 1) == []
    got = distinct.aggregate(rows, [], [], NAMES, tops={"x": 1 << 40, "y": 40}).first()
    assert got.asDict() == rows.agg(F.countDistinct("x").alias("a"), F.countDistinct("y").alias("b")).first().asDict()


def test_empty_frames(rows):
    assert distinct.aggregate(rows.limit(0), [], [], NAMES, tops={"x": 5, "y": 5}).first().asDict() == {"a": 0, "b": 0}
    assert distinct.aggregate(rows.limit(0), ["g"], [], NAMES, tops={"x": 5, "y": 5}).collect() == []


@pytest.mark.parametrize("report", [kpi.global_kpis, kpi.overview, kpi.monthly, kpi.countries, kpi.country_totals, kpi.sanity,
                                    analytics.seasonal, analytics.geographic])
def test_reports_scan_the_fact_once(spark, sf_dir, report):
    star = open_warehouse(spark, sf_dir).star()
    plan = report(star)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("SalesKey") <= 1 and plan.count("bitmap_construct_agg") and "Expand" not in plan
    assert plan.count("DaysToDeliver") == 1

"""The load moves and writes little: large members are hashed, lines are numbered in place, only keys travel."""

import pytest
from pyspark.sql import functions as F

from lakemart.operators import cleanse, dims, fact
from lakemart.plans.warehouse import new_warehouse
from lakemart.sinks import tables
from lakemart.sources import retail


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def not_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines_need_no_sort_for_large_members(spark, sf_dir, not_broadcast, monkeypatch):
    sorted_lines = rows(retail.retail_lines(spark, sf_dir, 4))
    monkeypatch.setattr(tables, "HASHED_ROWS", 1)
    hashed = retail.retail_lines(spark, sf_dir, 4)
    assert executed(hashed).count("ShuffledHashJoin") == 3              # parts, customers and invoices; one before
    assert rows(hashed) == sorted_lines


def test_only_what_follows_from_nothing_else_travels(spark, sf_dir, not_broadcast):
    plan = optimized(retail.retail_lines(spark, sf_dir, 4))
    moved = next(x for x in plan.splitlines() if "Project" in x and "AS InvoiceNo" in x and "l_partkey" in x)
    assert "l_orderkey#" not in moved.split("END AS InvoiceNo")[1]


def test_lines_from_raw_lines_without_counted_ones(spark, sf_dir, tmp_path):
    w = new_warehouse(spark, sf_dir, f"file://{tmp_path}/a")
    w.write("raw")
    lines = w.lines
    assert "counted" not in w._tables
    other = new_warehouse(spark, sf_dir, f"file://{tmp_path}/b")
    other.write("counted")
    assert rows(lines.drop("InvoiceKey")) == rows(other.lines.drop("InvoiceKey"))
    straight = cleanse.clean_from(cleanse.counted_lines(cleanse.typed_lines(retail.retail_lines(spark, sf_dir, w.dealt))))
    plan = cleanse.with_invoice_in_place(straight, w.dealt)
    assert rows(plan.drop("InvoiceKey")) == rows(lines.drop("InvoiceKey"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")              # else exchanges are shared while the query runs
    try:
        assert executed(plan.select("*")).count("ReusedExchange") >= 2     # lines and invoices travel once for both folds
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    plain = cleanse.with_invoice(cleanse.clean_from(w.counted))
    assert rows(lines.drop("InvoiceKey")) == rows(plain.select(*lines.drop("InvoiceKey").columns))
    pairs = lines.select("InvoiceNo", "InvoiceKey").distinct()
    n = pairs.count()
    assert n == pairs.select("InvoiceNo").distinct().count() == pairs.select("InvoiceKey").distinct().count()
    assert pairs.agg(F.min("InvoiceKey"), F.max("InvoiceKey") < 2 * n).first() == (1, True)
    assert "Exchange" not in executed(cleanse.with_invoice_in_place(cleanse.clean_from(w.counted), w.dealt))


def test_keys_and_values_are_written(spark, sf_dir, tmp_path, not_broadcast):
    w = new_warehouse(spark, sf_dir, f"file://{tmp_path}")
    whole = fact.fact_sales(w.lines, w.date, w.customer, w.product, w.location, "ETL_RUN",
                            F.lit("2001-09-01 00:00:00").cast("timestamp_ntz"))
    assert rows(w.unscored.drop("SalesKey").select(whole.columns)) == rows(whole)
    written = spark.read.parquet(f"file://{tmp_path}/fact_rows")
    assert not {"GrossProfit", "NetRevenue", "CostAmount", "SourceSystem"} & set(written.columns)
    assert written.select("SalesKey").distinct().count() == written.count()
    found = fact.with_buyer(w.lines.drop("TotalRevenue"), w.customer, "shuffle_hash", w.dealt)
    assert "Exchange" not in executed(found)                           # the buyers lie by invoice; one before
    moved = optimized(fact.rows_by_month(found, w.date, w.customer, w.product, w.location)).split("RebalancePartitions")[1]
    assert "TotalRevenue" not in moved.splitlines()[1] and "SalesKey" not in moved


def test_orders_of_a_product_are_told_apart_where_they_lie(spark, sf_dir, tmp_path, not_broadcast):
    w = new_warehouse(spark, sf_dir, f"file://{tmp_path}")
    pairs = lambda key: w.lines.select("StockCode", key).distinct()
    assert "Exchange" not in executed(pairs("InvoiceNo")) and "Exchange" in executed(pairs("InvoiceKey"))
    assert rows(dims.product_metrics(w.lines, "InvoiceNo")) == rows(dims.product_metrics(w.lines))

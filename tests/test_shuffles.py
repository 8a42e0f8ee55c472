"""What the load moves: lines lie by invoice, totals need no sort, constants do not travel."""

import datetime as dt

from pyspark.sql import functions as F

from lakemart.operators import cleanse, dims, fact
from lakemart.plans.warehouse import Warehouse, Settings


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_meet_their_invoice_without_moving(spark, edge_lines, tmp_path):
    w = Warehouse(spark, f"file://{tmp_path}", lambda: edge_lines)
    counted = w.counted
    assert sorted(map(str, counted.collect())) == sorted(map(str, cleanse.counted_lines(cleanse.typed_lines(edge_lines)).collect()))
    totals = cleanse.clean_from(counted).groupBy("InvoiceNo").agg(F.sum("Quantity").alias("n"))
    assert "Exchange" not in executed(totals)
    joined = cleanse.clean_from(counted).hint("merge").join(totals.withColumnRenamed("InvoiceNo", "i"), F.col("InvoiceNo") == F.col("i"))
    assert "Exchange" not in executed(joined)
    assert w.lines.count() == cleanse.clean_lines(cleanse.typed_lines(edge_lines)).count()


def test_first_values_where_dates_tie(spark):
    day = lambda d: dt.datetime(2011, 1, d)
    rows = [("A", "LATE", "1", day(2), 1), ("A", "SECOND", "2", day(1), 2), ("A", "FIRST", "10", day(1), 3),
            ("B", "ONE", "5", day(3), 4), ("B", "ONE", "6", day(1), 5), ("B", "TWO", "7", day(2), 6),
            ("C", "Y", "3", day(1), 7), ("C", "X", "3", day(1), 8)]
    lines = spark.createDataFrame(
        rows, "StockCode string, Description string, InvoiceNo string, InvoiceDate timestamp_ntz, Quantity int"
    ).withColumns({"UnitPrice": F.lit(2).cast("decimal(10,2)"), "TotalRevenue": (F.col("Quantity") * 2).cast("decimal(12,2)")})
    metrics = dims.product_metrics(lines)
    plain = {r[0]: r[1] for r in lines.groupBy("StockCode").agg(dims.first_by_date("Description")).collect()}
    got = {r["StockCode"]: r for r in metrics.collect()}
    assert {c: r["Description"] for c, r in got.items()} == plain == {"A": "FIRST", "B": "ONE", "C": "X"}
    assert {c: (r["TotalQuantitySold"], r["UniqueOrders"], float(r["TotalRevenue"]), r["AverageOrderQuantity"])
            for c, r in got.items()} == {"A": (6, 3, 12.0, 2.0), "B": (15, 3, 30.0, 5.0), "C": (15, 1, 30.0, 7.5)}


def test_constants_do_not_travel_with_the_fact(spark, edge_lines, tmp_path):
    w = Warehouse(spark, f"file://{tmp_path}", lambda: edge_lines, settings=Settings(run_id="R"))
    keyed = (fact.with_sales_key(w.lines), w.date, w.customer, w.product, w.location, "R", F.lit("2011-01-01"))
    sold = fact.fact_by_month(*keyed)
    whole = fact.fact_sales(*keyed)
    assert sold.schema == whole.schema
    assert sorted(map(str, sold.collect())) == sorted(map(str, whole.collect()))
    moved = optimized(sold).split("RebalancePartitions")[1].splitlines()[1]
    assert "SaleYear" in moved and "SourceSystem" not in moved and "ETLRunID" not in moved and "GrossProfit" not in moved
    assert "Sort" not in optimized(sold).split("RebalancePartitions")[1]

import datetime as dt

from pyspark.sql import functions as F

from lakemart.operators import cleanse, dims, fact, quality
from lakemart.plans.warehouse import Settings, Warehouse


def _lines(edge_lines):
    return cleanse.with_order_quantity(cleanse.clean_lines(cleanse.typed_lines(edge_lines)))


def test_date_dimension_fiscal_rules(spark):
    days = [dt.datetime(2011, 1, 3), dt.datetime(2011, 4, 1), dt.datetime(2011, 12, 31)]
    got = dims.dim_date(spark.createDataFrame([(d,) for d in days], "InvoiceDate timestamp_ntz")).orderBy("DateKey").collect()
    assert [r["DateKey"] for r in got] == [1, 2, 3]
    assert [r["FiscalYear"] for r in got] == [2010, 2011, 2011]
    assert [r["FiscalMonth"] for r in got] == [10, 1, 9]
    assert [r["FiscalQuarter"] for r in got] == [4, 2, 4]
    assert [r["FiscalQuarterApr"] for r in got] == [4, 1, 3]
    assert [r["DayName"] for r in got] == ["Mon", "Fri", "Sat"]
    assert got[2]["IsWeekend"] and got[2]["IsPeakSeason"] and got[0]["MonthName"] == "January"


def test_customer_dimension_has_one_unknown_member(edge_lines):
    got = {r["CustomerID"]: r for r in dims.dim_customer(_lines(edge_lines), F.lit("2011-01-20").cast("date")).collect()}
    assert got["UNKNOWN"]["CustomerKey"] == 0 and got["UNKNOWN"]["TotalOrders"] == 0
    assert got["UNKNOWN"]["Country"] == "UNKNOWN" and got["UNKNOWN"]["FirstPurchaseDate"] is None
    known = got["17850"]
    assert known["CustomerKey"] == 1 and known["CustomerRecency"] == 15
    assert known["CustomerSegment"] == "Champions_Premium" and known["CustomerStatus"] == "Active"


def test_recency_zero_falls_out_of_the_first_bin(edge_lines):
    got = dims.dim_customer(_lines(edge_lines)).where("CustomerKey = 1").first()
    assert got["CustomerRecency"] == 0 and got["CustomerSegment"].startswith("nan_")


def test_product_classes_first_match_wins(spark):
    rows = [("1", c, d, 1, dt.datetime(2011, 1, 1), "C", 2, 2) for c, d in [
        ("A", "SHOPPING BAG TOP"), ("B", "STOP WATCH"), ("C", "PAPER LAMP"), ("D", "GIANT SPOON"), ("E", "BOX GAME"),
    ]]
    lines = spark.createDataFrame(
        rows, "InvoiceNo string, StockCode string, Description string, Quantity int, InvoiceDate timestamp_ntz, "
              "CustomerID string, p int, r int"
    ).withColumn("UnitPrice", F.col("p").cast("decimal(10,2)")).withColumn("TotalRevenue", F.col("r").cast("decimal(12,2)"))
    got = {r["StockCode"]: r for r in dims.dim_product(lines).collect()}
    assert [got[c]["ProductCategory"] for c in "ABCDE"] == ["Bags", "Clothing", "Home", "General", "Home"]
    assert got["E"]["ProductLine"] == "Organization" and got["A"]["ProfitMargin"] == 40.0
    basic = {r["StockCode"]: r["ProductCategory"] for r in dims.dim_product_basic(lines).collect()}
    assert [basic[c] for c in "ABCDE"] == ["Bags", "Clothing", "General", "General", "Storage"]


def test_location_defaults(edge_lines):
    got = {r["Country"]: r for r in dims.dim_location(_lines(edge_lines)).collect()}
    assert got["France"]["Currency"] == "EUR" and got["Atlantis"]["Region"] == "Unknown"
    assert [got[c]["LocationKey"] for c in ("Atlantis", "France")] == [1, 2]


def test_fact_resolves_every_key(spark, edge_lines, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"), lambda: cleanse.typed_lines(edge_lines), settings=Settings(as_of="2011-02-01"))
    star = w.star()
    assert star.fact.count() == 8
    assert fact.missing_keys(star.fact).first()["missing_any"] == 0
    assert star.fact.where("CustomerKey = 0").count() == 2
    assert {float(r["DataQualityScore"]) for r in star.fact.select("DataQualityScore").distinct().collect()} == {0.5}
    assert star.fact.select("SalesKey").distinct().count() == 8
    orphans = quality.orphan_rows(star.fact, {
        "DimDate": star.date, "DimCustomer": star.customer.where("CustomerKey <> 0"),
        "DimProduct": star.product, "DimLocation": star.location,
    }).collect()
    assert {r["foreign_key"]: r["orphan_rows"] for r in orphans} == {
        "DateKey": 0, "CustomerKey": 2, "ProductKey": 0, "LocationKey": 0,
    }

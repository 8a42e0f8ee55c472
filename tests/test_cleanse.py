import datetime as dt

from pyspark.sql import functions as F

from lakemart.functions.columns import clean_text, in_range, right_closed_bin
from lakemart.operators import cleanse, fact


def test_typing_coerces_and_never_raises(spark):
    rows = [
        ("1", " P1 ", "nan", "5", "2011-01-05 10:00:00", "2.5", "17850.0", " France "),
        ("2", "P2", None, "five", "1/5/2011 10:07", "free", None, "USA"),
        ("3", "P3", "X", "7", "32/13/2011", "1", "nan", "USA"),
    ]
    names = "InvoiceNo string, StockCode string, Description string, Quantity string, InvoiceDate string, " \
            "UnitPrice string, CustomerID string, Country string"
    got = {r["InvoiceNo"]: r for r in cleanse.typed_lines(spark.createDataFrame(rows, names)).collect()}
    assert (got["1"]["StockCode"], got["1"]["Description"], got["1"]["CustomerID"]) == ("P1", "", "17850")
    assert got["1"]["Country"] == "France" and got["1"]["Quantity"] == 5
    assert got["2"]["Quantity"] is None and got["2"]["UnitPrice"] is None
    assert got["2"]["InvoiceDate"] == dt.datetime(2011, 1, 5, 10, 7)
    assert got["2"]["CustomerID"] == "UNKNOWN" and got["3"]["CustomerID"] == "UNKNOWN"
    assert got["3"]["InvoiceDate"] is None


def test_funnel_counts_every_row_once(edge_lines):
    typed = cleanse.typed_lines(edge_lines)
    funnel = {r["rule"]: r["records"] for r in cleanse.reject_funnel(typed).collect()}
    assert funnel == {
        "initial_records": 20, "cancelled_orders": 1, "invalid_quantities": 4, "invalid_prices": 3,
        "missing_critical_data": 1, "duplicates": 1, "empty_product_info": 2, "final_records": 8,
    }
    lost = sum(n for rule, n in funnel.items() if rule in cleanse.REJECT_RULES)
    assert lost + funnel["final_records"] == funnel["initial_records"]
    assert cleanse.clean_lines(typed).count() == funnel["final_records"]
    quarantined = cleanse.rejected_lines(typed).groupBy("reject_reason").agg(F.sum("copies").alias("n")).collect()
    assert {r["reject_reason"]: r["n"] for r in quarantined} == {
        k: v for k, v in funnel.items() if k in cleanse.REJECT_RULES
    }


def test_order_quantity_and_parts(edge_lines):
    lines = cleanse.with_order_quantity(cleanse.clean_lines(cleanse.typed_lines(edge_lines)))
    got = {r["InvoiceNo"]: r for r in cleanse.with_date_parts(lines).collect()}
    assert got["6"]["OrderQuantity"] == 4
    assert got["1"]["InvoiceDayOfWeek"] == 2 and got["1"]["Season"] == "Winter" and not got["1"]["IsWeekend"]


def test_unknown_fanout_doubles_unknown_lines(edge_lines):
    lines = cleanse.clean_lines(cleanse.typed_lines(edge_lines))
    unknown = lines.where("CustomerID = 'UNKNOWN'").count()
    assert unknown == 2
    assert fact.unknown_fanout(lines).count() == lines.count() + unknown


def test_scalar_helpers(spark):
    df = spark.createDataFrame([(" a ", "5"), ("NaN", "x"), ("", None), (None, "0")], "t string, q string")
    got = df.select(clean_text(F.col("t")).alias("t"), in_range(F.col("q"), 1, 100).alias("ok")).collect()
    assert [r["t"] for r in got] == ["a", None, None, None]
    assert [r["ok"] for r in got] == [True, False, False, False]
    edges = spark.createDataFrame([(0,), (30,), (31,), (1000,)], "v int")
    bins = edges.select(right_closed_bin(F.col("v"), [0, 30, None], ["low", "high"]).alias("b")).collect()
    assert [r["b"] for r in bins] == [None, "low", "high", "high"]

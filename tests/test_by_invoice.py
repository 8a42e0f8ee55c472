"""Lines travel by invoice once: no exchange between source, counted lines and lines; buyers are found once an invoice."""

from pyspark.sql import functions as F

from lakemart.operators import cleanse, fact
from lakemart.plans.warehouse import Settings, Warehouse, new_warehouse
from lakemart.sources import retail


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_come_dealt_by_invoice(spark, sf_dir, tmp_path):
    w = new_warehouse(spark, sf_dir, f"file://{tmp_path}")
    dealt = retail.retail_lines(spark, sf_dir, w.dealt)
    typed = cleanse.typed_lines(dealt)
    exchanges = executed(dealt).count("Exchange hashpartitioning(InvoiceNo")
    assert exchanges == 2                                     # lines, and their invoices
    assert executed(cleanse.counted_lines(typed)).count("Exchange hashpartitioning") == executed(dealt).count(
        "Exchange hashpartitioning")                          # a second one before
    assert "Exchange" not in executed(cleanse.counted_lines(cleanse.typed_lines(w.raw)))
    assert len(w.counted.inputFiles()) <= w.dealt and len(w.lines.inputFiles()) <= w.dealt


def test_wide_input_gets_more_partitions(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(retail, "LINES_A_TASK", 500)
    lines = retail.read_table(spark, sf_dir, "lineitem").count()
    assert retail.invoice_width(spark, sf_dir) == -(-lines // 500)


def test_the_fact_is_dealt_twice_only(spark, sf_dir, tmp_path):
    w = new_warehouse(spark, sf_dir, f"file://{tmp_path}")
    keyed = fact.with_buyer(fact.with_sales_key(w.lines), w.customer, "shuffle_hash")
    assert executed(keyed).count("Exchange") == 1 and "xxhash64" not in executed(keyed)        # the buyers go to their invoices
    assert keyed.count() == w.lines.count() == keyed.select("SalesKey").distinct().count()


def test_an_invoice_with_several_customers(spark, edge_lines, tmp_path):
    rows = [("20", "P1", "A", 1, "2011-01-05 10:00:00", "1.00", "1", "France"),
            ("20", "P2", "B", 1, "2011-01-05 10:00:00", "1.00", "2", "France"),
            ("20", "P3", "C", 1, "2011-01-05 10:00:00", "1.00", None, "France")]
    more = spark.createDataFrame(rows, edge_lines.drop("UnitPrice").schema.names[:5] + ["UnitPrice", "CustomerID", "Country"]) \
        .withColumn("UnitPrice", F.col("UnitPrice").cast("decimal(10,2)")).withColumn("Quantity", F.col("Quantity").cast("int"))
    w = Warehouse(spark, f"file://{tmp_path}", lambda: edge_lines.unionByName(more.select(edge_lines.columns)),
                  settings=Settings(run_id="R"))
    plain = fact.lookup_keys(w.lines, w.date, w.customer, w.product, w.location)
    got = fact.with_buyer(fact.with_sales_key(w.lines), w.customer)
    pick = ("InvoiceNo", "StockCode", "CustomerID", "CustomerKey")
    assert sorted(map(str, got.select(*pick).collect())) == sorted(map(str, plain.select(*pick).collect()))
    assert got.select("SalesKey").distinct().count() == w.lines.count()
    assert w.unscored.count() == w.lines.count()


def test_assembled_fact_is_the_written_one(spark, sf_dir, tmp_path):
    w = new_warehouse(spark, sf_dir, f"file://{tmp_path}")
    assembled = w.assemble_fact()
    assert "Join" not in executed(assembled) and "InvoiceKey" not in assembled.columns
    whole = fact.fact_sales(w.lines.drop("InvoiceKey"), w.date, w.customer, w.product, w.location, "ETL_RUN",
                            F.lit("2001-09-01 00:00:00").cast("timestamp_ntz"), F.lit(w.score))
    assert assembled.columns == whole.columns
    assert sorted(map(str, assembled.collect())) == sorted(map(str, whole.collect()))

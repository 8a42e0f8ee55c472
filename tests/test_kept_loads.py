"""Loads that extend a star: lines stay by invoice, days and months are told from one order, lineage writes lines once."""

import datetime as dt
import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from lakemart.operators import aggregates, cleanse, fact, lineage, sketches
from lakemart.plans import etl, warehouse
from lakemart.plans.warehouse import DRIVER_SETTINGS, new_warehouse
from lakemart.sinks import tables


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def not_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def order_tables(spark, tmp_path_factory):
    """Order tables of our own: orders of several years, repeated lines, unknown buyers, orders that go on."""
    rng, place = random.Random(11), str(tmp_path_factory.mktemp("tables"))
    day = lambda: dt.datetime(1996, 1, 1) + dt.timedelta(days=rng.randint(0, 1500))
    made = {
        "region": ([(i, f"REGION_{i}") for i in range(3)], "r_regionkey int, r_name string"),
        "nation": ([(i, f"NATION_{i}", i % 3) for i in range(12)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(i, i % 12) for i in range(60)], "c_custkey long, c_nationkey int"),
        "supplier": ([(i, i % 12) for i in range(5)], "s_suppkey long, s_nationkey int"),
        "part": ([(i, rng.choice(["small widget", "anvil", "gear", "plain thing"]), 900.0 + i) for i in range(150)],
                 "p_partkey long, p_name string, p_retailprice double"),
        "orders": ([(i, rng.randrange(60), day()) for i in range(400)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
        "lineitem": ([(rng.randrange(400), rng.randrange(150), float(rng.randint(1, 50)), rng.choice("RAN"), rng.choice("FO"), day())
                      for _ in range(2500)], "l_orderkey long, l_partkey long, l_quantity double, l_returnflag string, "
                     "l_linestatus string, l_shipdate timestamp_ntz"),
    }
    for name, (data, schema) in made.items():
        spark.createDataFrame(data, schema).coalesce(2).write.parquet(f"{place}/{name}.parquet")
    return place


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return round(float(value), 6) if isinstance(value, (int, float)) and not isinstance(value, bool) else str(value)


@pytest.mark.parametrize("name", ["agg_monthly_kept", "incr_load", "agg_daily_kept", "lineage_log"])
def test_query_matches_sql(spark, order_tables, not_broadcast, name):
    database = duckdb.connect()
    for table in ("region", "nation", "customer", "part", "orders", "lineitem"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{order_tables}/{table}.parquet/*.parquet'")
    expected = database.sql(contract.oracle_sql()[name])
    df = contract.queries()[name](spark, order_tables)
    names = sorted(df.columns)
    assert names == sorted(expected.columns)
    mine = [tuple(_plain(r[c]) for c in names) for r in df.collect()]
    theirs = [tuple(_plain(r[expected.columns.index(c)]) for c in names) for r in expected.fetchall()]
    assert sorted(mine, key=repr) == sorted(theirs, key=repr) and mine


def test_lines_stay_by_invoice_through_a_load(spark, order_tables, tmp_path, not_broadcast):
    w = new_warehouse(spark, order_tables, f"file://{tmp_path}/w")
    root, day = f"file://{tmp_path}/star", F.lit("1998-01-15").cast("timestamp_ntz")
    etl.load(spark, w.raw.where((F.col("InvoiceDate") < day) | F.col("InvoiceDate").isNull()), root, DRIVER_SETTINGS, dealt=w.dealt)
    first = etl.newest_load(spark, root)
    assert [p.width for p in first.parts] == [w.dealt]
    held = etl._held_lines(spark, first)
    assert "Exchange" not in executed(held.groupBy("InvoiceNo").agg(F.sum("Quantity")))
    clean = cleanse.clean_from(w.counted)
    plain = [c for c in held.columns if c not in ("OrderQuantity", "InvoiceKey")]
    fresh = etl._without(clean.select(*plain), held)
    assert rows(fresh) == rows(clean.select(*plain).subtract(held.select(*plain)))
    # lines of invoices that are not held do not move; a set difference of all lines moves them by every column
    alone = clean.select(*plain).join(held.select("InvoiceNo").distinct().hint("shuffle_hash"), "InvoiceNo", "left_anti")
    assert "Exchange" not in executed(alone) and "Exchange" in executed(clean.select(*plain).subtract(held.select(*plain)))
    # a dealt load and one that is not make the star of all lines
    star = etl.load(spark, w.raw, root, DRIVER_SETTINGS, since="1998-01-15")
    pick = ("InvoiceNo", "Quantity", "UnitPrice", "TotalRevenue", "OrderQuantity")
    assert rows(star.fact.select(*pick)) == rows(w.lines.select(*pick))
    for mine, whole, key in ((star.customer, w.customer, "CustomerKey"), (star.product, w.product, "ProductKey")):
        assert rows(mine.drop(key)) == rows(whole.drop(key))
    assert star.fact.select("SalesKey").distinct().count() == star.fact.count()
    assert star.fact.select("InvoiceNo", "InvoiceKey").distinct().count() == star.fact.select("InvoiceNo").distinct().count() \
        == star.fact.select("InvoiceKey").distinct().count()


def test_lines_without_an_invoice_have_a_buyer(spark, tmp_path):
    people = spark.createDataFrame([("A", 1), ("B", 2)], "CustomerID string, CustomerKey long")
    lines = spark.createDataFrame(
        [("1", "A", 1), ("1", "A", 2), ("2", "A", 3), ("2", "B", 4), (None, "B", 5), (None, "UNKNOWN", 6), (None, "B", 7)],
        "InvoiceNo string, CustomerID string, SalesKey long").withColumn("StockCode", F.lit("P"))
    got = fact.with_buyer(lines, people, "shuffle_hash", 4).select(F.col("SalesKey") % 16, "CustomerKey", "SalesKey").collect()
    assert sorted((r[0], r[1]) for r in got) == [(1, 1), (2, 1), (3, 1), (4, 2), (5, 2), (6, 0), (7, 2)]     # four before
    assert len({r[2] for r in got}) == 7


def test_days_and_months_from_one_order(spark, not_broadcast):
    rng = random.Random(3)
    data = [(2000, m, m * 100 + rng.randint(1, 3), rng.randint(0, 2), 1, rng.randint(1, 900), rng.randint(1, 5),
             rng.choice([None, *range(6)]), rng.choice([None, *range(5)])) for m in (1, 2) for _ in range(150)]
    sales = spark.createDataFrame(data, "SaleYear int, SaleMonth int, DateKey long, CustomerKey long, LocationKey long, r int, "
                                  "Quantity int, InvoiceKey long, ProductKey long").withColumn("TotalRevenue", F.col("r").cast("decimal(12,2)"))
    days = aggregates.daily_base(sales, firsts=True)
    assert executed(days).count("Exchange") == 1 and executed(days).count("Window ") == 2     # two exchanges and four windows before
    assert rows(days.select(*aggregates.DAILY)) == rows(aggregates.daily_base(sales).select(*aggregates.DAILY))
    months, plain = aggregates.monthly_base(days), aggregates.monthly_base(sales)
    assert rows(months.select(*plain.columns)) == rows(plain)
    exact = sales.groupBy("SaleYear", "SaleMonth", "CustomerKey", "LocationKey").agg(
        F.countDistinct("InvoiceKey").alias("OrderCount"), F.countDistinct("ProductKey").alias("UniqueProducts"))
    assert rows(months.select(*exact.columns)) == rows(exact)


def test_sketches_fold_measures_made_once(spark):
    data = [("2011-01-05", 3, "2.50", "ab"), ("2011-01-06", None, None, None), ("2011-02-01", -4, "0.00", ""), (None, 2147483647, "99999999.99", "x")]
    lines = spark.createDataFrame(data * 3, "d string, q int, p string, t string").select(
        F.col("d").cast("timestamp_ntz").alias("InvoiceDate"), "q", F.col("p").cast("decimal(10,2)").alias("p"), "t")
    months = sketches.month_sketches(lines, ("q", "p", "t"))
    fold = months._jdf.queryExecution().optimizedPlan().toString().split("Aggregate [")[1].split("Project [")[0]
    assert "cast(p#" not in fold and "length(t#" not in fold and "cast(q#" not in fold        # made anew for every figure before
    length = {"q": F.col("q"), "p": F.col("p"), "t": F.length("t")}
    for c, v in length.items():
        exact = lines.groupBy(F.year("InvoiceDate").alias("y"), F.month("InvoiceDate").alias("m")).agg(
            F.count(F.lit(1)), F.count_if(v.isNull()), F.count_if(v == 0), F.count_if(v < 0), F.min(v.cast("decimal(18,2)")),
            F.max(v.cast("decimal(18,2)")), F.sum(v.cast("decimal(18,2)")).cast("decimal(38,2)"))
        got = months.where(F.col("column_name") == c).select(
            "SaleYear", "SaleMonth", "records", "null_count", "zero_count", "negative_count", "least", "most", "total")
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, exact.collect())))
        assert [f.dataType.simpleString() for f in got.schema.fields[6:]] == ["decimal(18,2)", "decimal(18,2)", "decimal(38,2)"]


def test_lineage_writes_lines_once_and_leaves_them_by_invoice(spark, order_tables, tmp_path, not_broadcast, monkeypatch):
    monkeypatch.setattr(warehouse, "_OPEN", {})
    written = []

    def recorded(write):
        def run(df, path, *args, **more):
            written.append(path)
            return write(df, path, *args, **more)
        return run

    for place in (lineage, warehouse):
        monkeypatch.setattr(place, "write_table", recorded(tables.write_table))
        monkeypatch.setattr(place, "write_bucketed", recorded(tables.write_bucketed))
    counts = [(r["SourceRecordCount"], r["TargetRecordCount"]) for r in contract.queries()["lineage_log"](spark, order_tables).collect()]
    assert [p.rsplit("/", 1)[1] for p in written].count("lines") == 1                       # two before
    at = next(p for p in written if p.endswith("/lines"))
    lines = spark.read.parquet(at)
    assert counts[0][1] == counts[1][0] == lines.count() and counts[1][1] == spark.read.parquet(at[:-5] + "fact").count()
    w = new_warehouse(spark, order_tables, f"file://{tmp_path}/w")
    assert rows(lines.select(*w.lines.drop("InvoiceKey").columns)) == rows(w.lines.drop("InvoiceKey"))
    keyed = fact.lookup_keys(w.lines.drop("InvoiceKey"), w.date, w.customer, w.product, w.location)
    assert rows(spark.read.parquet(at[:-5] + "fact").select(*keyed.columns)) == rows(keyed)
    # written once more by its own lines, the log counts the same
    assert w.members_of(lines, "nowhere") is w

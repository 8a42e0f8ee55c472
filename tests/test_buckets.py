"""Tables that lie by key: joins on the key leave them where they are."""

import re

import pytest
from pyspark.sql import functions as F

from lakemart.operators import fact
from lakemart.sinks import tables as sinks


@pytest.fixture
def large_sides(spark):
    """Sides too large to broadcast, as at scale."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def _exchanged(df):
    """Keys that the plan shuffles by."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\((\w+?)#", plan)


def _lines(spark, n):
    return spark.range(n).select(
        F.col("id").cast("string").alias("InvoiceNo"), (F.col("id") % 97).cast("string").alias("StockCode"),
        F.when(F.col("id") % 5 > 0, F.lit("x")).alias("Description"), (F.col("id") % 50).cast("string").alias("CustomerID"),
        F.lit("France").alias("Country"), F.timestamp_micros(F.col("id") * 1_000_000).cast("timestamp_ntz").alias("InvoiceDate"))


def test_history_stays_where_it_lies(spark, tmp_path, large_sides):
    columns = ["InvoiceNo", "StockCode", "Description"]
    keyed = fact.with_line_key(_lines(spark, 3000), columns)
    held = sinks.write_bucketed(keyed.where("cast(InvoiceNo as int) < 2000"), str(tmp_path / "held"), ["LineKey"], 8)
    fresh = fact.new_lines(keyed, held)
    assert fresh.count() == 1000 and fresh.agg(F.min(F.col("InvoiceNo").cast("int"))).first()[0] == 2000
    assert _exchanged(fresh) == ["LineKey"]
    loose = fact.new_lines(keyed, spark.read.parquet(str(tmp_path / "held")))
    assert _exchanged(loose) == ["LineKey", "LineKey"]
    # a session whose catalog does not know the table declares it over the written files
    name = sinks._bucketed_name(str(tmp_path / "held"))
    spark.sql(f"DROP TABLE {name}")
    again = fact.new_lines(keyed, sinks.open_bucketed(spark, str(tmp_path / "held"), held.schema, ["LineKey"], 8))
    assert again.count() == 1000 and _exchanged(again) == ["LineKey"]
    # written anew, the table holds the new rows only
    less = sinks.write_bucketed(keyed.limit(10), str(tmp_path / "held"), ["LineKey"], 8)
    assert less.count() == 10
    spark.sql(f"DROP TABLE {name}")


def test_key_lookup_moves_the_lines_only(spark, tmp_path, large_sides):
    people = spark.range(50).select(F.col("id").cast("string").alias("CustomerID"), (F.col("id") + 1).alias("CustomerKey"))
    goods = spark.range(97).select(F.col("id").cast("string").alias("StockCode"), (F.col("id") + 1).alias("ProductKey"))
    date = spark.sql("SELECT date'1970-01-01' AS FullDate, 1 AS DateKey")
    place = spark.sql("SELECT 'France' AS Country, 1L AS LocationKey")
    lines = _lines(spark, 500)
    plain = fact.lookup_keys(lines, date, people, goods, place)
    lying = fact.lookup_keys(lines, date, sinks.write_bucketed(people, str(tmp_path / "c"), ["CustomerID"], 8),
                             sinks.write_bucketed(goods, str(tmp_path / "p"), ["StockCode"], 8), place)
    columns = ["InvoiceNo", "CustomerKey", "ProductKey", "LocationKey", "DateKey"]
    assert sorted(map(tuple, lying.select(*columns).collect())) == sorted(map(tuple, plain.select(*columns).collect()))
    moved = lying.select(*columns)
    assert _exchanged(moved).count("CustomerID") == 0 and _exchanged(moved).count("StockCode") == 1


def test_line_keys_tell_nulls_and_texts_apart(spark):
    rows = spark.createDataFrame([("a", None), ("a", ""), ("a", "-"), (None, "a"), ("a=", ""), ("", "a=")], "x string, y string")
    assert fact.with_line_key(rows, ["x", "y"]).select("LineKey").distinct().count() == 6

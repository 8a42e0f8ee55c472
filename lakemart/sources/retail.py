"""Retail invoice lines out of the order tables, with the usual dirt planted.

The warehouse needs raw invoice lines (eight columns). This adapter derives them
from lineitem, orders, customer, nation and part in one pass: cancelled
invoices, returns, free items, unknown customers, missing dates, blank
descriptions and exact duplicates all occur at fixed places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.session import shuffle_width
from lakemart.sinks.tables import hashed

LINES_A_TASK = 250_000       # invoice lines that one task sorts and folds


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def invoice_width(spark: SparkSession, sf_dir: str) -> int:
    """Partitions that the lines are dealt into by invoice: more than the session's where these would be large."""
    return max(shuffle_width(spark), -(-read_table(spark, sf_dir, "lineitem").count() // LINES_A_TASK))


def retail_lines(spark: SparkSession, sf_dir: str, width: int | None = None) -> DataFrame:
    """The lines, dealt by the hash of InvoiceNo into ``width`` partitions.

    A line's invoice follows from the line alone, and an order's buyer and day are known before
    its lines are: lines travel by invoice once and stay there for all that is done by invoice.
    """
    width = width or invoice_width(spark, sf_dir)
    cancelled = (
        (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F") & (F.col("l_orderkey") % 3 == 0)
    )
    quantity = F.col("l_quantity").cast("int")
    # what follows from a line, a part or an order alone is settled before the joins, and only that travels
    lines = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", cancelled.alias("__cancelled"),
        F.when(F.col("l_orderkey") % 50 == 7, -quantity).otherwise(quantity).alias("Quantity"),
    )
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    parts = read_table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_partkey") % 89 == 4, "").otherwise(F.upper("p_name")).alias("Description"),
        F.when(F.col("p_partkey") % 101 == 5, F.lit(0)).otherwise(F.col("p_retailprice"))
        .cast("decimal(10,2)").alias("UnitPrice"),
    )
    order_text = F.col("l_orderkey").cast("string")
    numbered = lines.join(hashed(parts), F.col("l_partkey") == F.col("p_partkey")).select(
        F.when(F.col("__cancelled"), F.concat(F.lit("C"), order_text)).otherwise(order_text).alias("InvoiceNo"),
        "l_partkey", "Description", "Quantity", "UnitPrice",
    )
    # an order may have an ordinary and a cancelled invoice
    invoice = F.col("o_orderkey").cast("string")
    invoices = orders.join(hashed(customers), F.col("o_custkey") == F.col("c_custkey")).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.explode(F.when(F.col("o_orderkey") % 3 == 0, F.array(invoice, F.concat(F.lit("C"), invoice)))
                  .otherwise(F.array(invoice))).alias("InvoiceNo"),
        "o_custkey", "n_name", (F.col("o_orderkey") % 40 == 1).alias("__twice"),
        F.when(F.col("o_orderkey") % 97 != 3, F.col("o_orderdate").cast("timestamp_ntz")).alias("InvoiceDate"))
    # both large: shuffled, never broadcast; a partition's invoices are few enough to be hashed, and its lines need no sort
    joined = numbered.repartition(width, "InvoiceNo").join(
        invoices.repartition(width, "InvoiceNo").hint("shuffle_hash"), "InvoiceNo")
    copies = F.expr("IF(__twice, array(0, 1), array(0))")
    return joined.select(
        "InvoiceNo",
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("StockCode"),
        "Description", "Quantity", "InvoiceDate", "UnitPrice",
        F.when(F.col("o_custkey") % 20 != 0, F.col("o_custkey").cast("string")).alias("CustomerID"),
        F.col("n_name").alias("Country"),
        F.explode(copies).alias("__copy"),
    ).drop("__copy")


def text_lines(raw: DataFrame) -> DataFrame:
    """The same lines as a CSV would hold them: all text, some of it unreadable.

    Every third stock code writes the date as M/d/yyyy H:mm, customer numbers
    carry the '.0' of a float export, unknown customers of even invoices read
    'nan', and quantities of 13 pieces read 'n/a'.
    """
    number = F.substring("StockCode", 2, 20).cast("bigint")
    us_date = F.date_format("InvoiceDate", "M/d/yyyy H:mm")
    iso_date = F.date_format("InvoiceDate", "yyyy-MM-dd HH:mm:ss")
    return raw.select(
        "InvoiceNo",
        F.concat(F.lit(" "), F.col("StockCode")).alias("StockCode"),
        F.when(F.col("Description") != "", F.concat("Description", F.lit("  "))).alias("Description"),
        F.when(F.col("Quantity") == 13, "n/a").otherwise(F.col("Quantity").cast("string")).alias("Quantity"),
        F.coalesce(F.when(number % 3 == 0, us_date).otherwise(iso_date), F.lit("not a date")).alias("InvoiceDate"),
        F.col("UnitPrice").cast("string").alias("UnitPrice"),
        F.when(F.col("CustomerID").isNotNull(), F.concat("CustomerID", F.lit(".0")))
        .when(F.col("InvoiceNo").endswith("0"), "nan").alias("CustomerID"),
        F.concat(F.col("Country"), F.lit(" ")).alias("Country"),
    )


def country_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country to region lookup from nation and region.

    Every ninth nation stays out, so the default 'Unknown' occurs as well.
    """
    nations = read_table(spark, sf_dir, "nation")
    regions = read_table(spark, sf_dir, "region")
    half = F.when(F.col("n_nationkey") % 2 == 0, " North").otherwise(" South")
    return (
        nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .where(F.col("n_nationkey") % 9 != 8)
        .select(
            F.col("n_name").alias("Country"),
            F.concat(F.col("r_name"), half).alias("Region"),
            F.col("r_name").alias("Continent"),
            F.substring("r_name", 1, 3).alias("Currency"),
            (F.col("n_nationkey") == 0).alias("IsPrimaryMarket"),
        )
    )


def receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Goods received: open line items on their ship date, as (StockCode, Country, day, pieces, UnitPrice)."""
    lines = read_table(spark, sf_dir, "lineitem").where(F.col("l_linestatus") == "O").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_shipdate"
    )
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    parts = read_table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("StockCode"),
            F.col("n_name").alias("Country"),
            F.to_date("l_shipdate").alias("day"),
            F.col("l_quantity").cast("int").alias("pieces"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("UnitPrice"),
        )
    )

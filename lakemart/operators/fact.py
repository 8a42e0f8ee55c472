"""Sales fact assembly: surrogate-key lookups and financial measures."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart import config
from lakemart.operators.cleanse import revenue
from lakemart.session import work_dir
from lakemart.sinks.tables import dealt_by, hashed, write_bucketed, write_table

FOREIGN_KEYS = ["DateKey", "CustomerKey", "ProductKey", "LocationKey", "ChannelKey"]
SPREAD = 4096


def _with_customer_key(rows: DataFrame, name: str, customer: DataFrame, spread_by: list[str]) -> DataFrame:
    """Rows with the key of the customer in column ``name``.

    Unknown customers match nothing on purpose: their join key is spread over many values, so
    they never meet in one shuffle partition, and they get key 0 afterwards.
    """
    unknown = F.col(name) == config.UNKNOWN
    spread = F.concat(F.lit(config.UNKNOWN + "#"), F.pmod(F.xxhash64(*spread_by), F.lit(SPREAD)))
    people = hashed(customer.where(F.col("CustomerID") != config.UNKNOWN).select(
        F.col("CustomerID").alias("__customer"), "CustomerKey"
    ))
    return (
        rows.withColumn("__customer", F.when(unknown, spread).otherwise(F.col(name)))
        .join(people, "__customer", "left")
        .withColumn("CustomerKey", F.when(unknown, F.lit(0).cast("long")).otherwise(F.col("CustomerKey")))
        .drop("__customer")
    )


def lookup_keys(lines: DataFrame, date: DataFrame, customer: DataFrame, product: DataFrame,
                location: DataFrame) -> DataFrame:
    """Left-join the four dimensions for their keys; lines may have their CustomerKey already.

    Dimensions are written tables, so Spark knows their size and broadcasts the
    small ones only. Lines travel to a large product dimension with the place's key, not its name.
    """
    days = date.select(F.col("FullDate").alias("__day"), "DateKey")
    keyed = (
        lines.withColumn("__day", F.to_date("InvoiceDate"))
        .join(location.select("Country", "LocationKey"), "Country", "left")
        .join(hashed(product.select("StockCode", "ProductKey")), "StockCode", "left")
        .join(days, "__day", "left")
    )
    if "CustomerKey" not in lines.columns:
        keyed = _with_customer_key(keyed, "CustomerID", customer, ["InvoiceNo", "StockCode"])
    return keyed.withColumn("ChannelKey", F.lit(config.CHANNEL[0]))


def with_buyer(lines: DataFrame, customer: DataFrame, by: str = "merge", width: int | None = None) -> DataFrame:
    """Lines with their CustomerKey, found once an invoice where it names one customer.

    Lines that lie by invoice stay where they are; with ``width``, the number of partitions they lie in,
    the buyers are written as they lie and need not come to them again. Those of an invoice with several
    customers, and lines without an invoice, are looked up one by one; these parts are scans of their own, so
    sales keys are kept apart.
    """
    pairs = lines.select("InvoiceNo", "CustomerID").distinct()
    found = _with_customer_key(pairs, "CustomerID", customer, ["InvoiceNo"])
    bought = (found.repartition(width, "InvoiceNo") if width else found).groupBy("InvoiceNo").agg(
        F.max("CustomerKey").alias("CustomerKey"), F.count(F.lit(1)).alias("__customers"))
    place = work_dir(lines.sparkSession, "buyers", uuid.uuid4().hex)
    bought = write_bucketed(bought, place, ["InvoiceNo"], width, dealt=True) if width else write_table(bought, place)
    one = bought.where("__customers = 1").select("InvoiceNo", "CustomerKey")
    found = lines.join(one.hint(by), "InvoiceNo")
    mixed = bought.where("__customers > 1").select("InvoiceNo")
    loose = [(lines.join(mixed, "InvoiceNo", "left_semi"), 1 << 49, mixed),
             (lines.where("InvoiceNo IS NULL"), 3 << 48, bought.where("InvoiceNo IS NULL"))]
    for several, apart, invoices in loose:
        if not invoices.isEmpty():
            if "SalesKey" in lines.columns:
                several = several.withColumn("SalesKey", F.col("SalesKey") + F.lit(apart))
            found = found.unionByName(_with_customer_key(several, "CustomerID", customer, ["InvoiceNo", "StockCode"]))
    return found


def with_line_key(lines: DataFrame, columns: list[str]) -> DataFrame:
    """Lines with LineKey, a 256-bit digest of the given columns; nulls differ from every text."""
    text = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns]
    whole = F.concat_ws("", *[F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in text])
    return lines.withColumn("LineKey", F.unhex(F.sha2(whole.cast("binary"), 256)))


def new_lines(lines: DataFrame, held: DataFrame) -> DataFrame:
    """Lines (with LineKey) that ``held`` does not have.

    Where ``held`` is bucketed by LineKey the history stays where it lies and only the new
    lines are shuffled.
    """
    return lines.join(held.select("LineKey"), "LineKey", "left_anti")


def measures(keyed: DataFrame, run_id: str, loaded_at: Column, score: Column | None = None) -> DataFrame:
    """Financial measures and load metadata. Cost, discount, tax, returns and
    delivery days are not in the source and stay zero."""
    sold = F.col("TotalRevenue")
    zero_money = F.lit(0).cast("decimal(10,2)")
    profit = (sold - zero_money).cast("decimal(12,2)")
    margin = F.round(F.try_divide(profit * 100, sold), 2).cast("decimal(5,2)")
    key = [c for c in ("SalesKey", "InvoiceKey") if c in keyed.columns]
    month = ["SaleYear", "SaleMonth"] if "SaleYear" in keyed.columns else [
        F.year("__day").alias("SaleYear"), F.month("__day").alias("SaleMonth")]
    return keyed.select(
        *FOREIGN_KEYS,
        *key,
        "InvoiceNo",
        F.lit(1).alias("LineItemNo"),
        "Quantity",
        "UnitPrice",
        "TotalRevenue",
        zero_money.alias("CostAmount"),
        profit.alias("GrossProfit"),
        margin.alias("GrossMargin"),
        zero_money.alias("DiscountAmount"),
        (sold - zero_money).cast("decimal(12,2)").alias("NetRevenue"),
        zero_money.alias("TaxAmount"),
        "OrderQuantity",
        F.lit(0).alias("ReturnQuantity"),
        zero_money.alias("ReturnAmount"),
        F.lit(0).alias("DaysToShip"),
        "DaysToDeliver" if "DaysToDeliver" in keyed.columns else F.lit(0).alias("DaysToDeliver"),
        loaded_at.cast("timestamp_ntz").alias("LoadTimestamp"),
        F.lit(config.SOURCE_SYSTEM).alias("SourceSystem"),
        (score if score is not None else F.lit(1.0)).cast("decimal(3,2)").alias("DataQualityScore"),
        F.lit(run_id).alias("ETLRunID"),
        *month,
    )


def with_sales_key(lines: DataFrame, load: int = 0) -> DataFrame:
    """A unique key per line of one load, from the line's place in the written table.

    It is given on the scan, before any shuffle: a task that runs again reads the same
    split and gives the same keys.
    """
    return lines.withColumn("SalesKey", F.lit(load).cast("long") * (1 << 50) + F.monotonically_increasing_id())


def scored(unscored: DataFrame, score: float) -> DataFrame:
    """The fact with its load's quality score, one number for all rows of a load: given when the table is read."""
    return unscored.withColumn("DataQualityScore", F.lit(score).cast("decimal(3,2)"))


def missing_keys(fact: DataFrame) -> DataFrame:
    """Rows without one of their foreign keys, per key and in total, in one aggregate."""
    any_missing = None
    for key in FOREIGN_KEYS:
        gone = F.col(key).isNull()
        any_missing = gone if any_missing is None else any_missing | gone
    return fact.agg(
        F.count(F.lit(1)).alias("records"),
        *[F.count_if(F.col(k).isNull()).alias(f"missing_{k}") for k in FOREIGN_KEYS],
        F.count_if(any_missing).alias("missing_any"),
    )


def fact_sales(lines: DataFrame, date: DataFrame, customer: DataFrame, product: DataFrame,
               location: DataFrame, run_id: str, loaded_at: Column, score: Column | None = None) -> DataFrame:
    """The sales fact: rows whose keys all resolve."""
    keyed = lookup_keys(lines, date, customer, product, location)
    return measures(keyed.na.drop(subset=FOREIGN_KEYS), run_id, loaded_at, score)


def rows_by_month(lines: DataFrame, date: DataFrame, customer: DataFrame, product: DataFrame,
                  location: DataFrame) -> DataFrame:
    """Keys and values of the sales fact, dealt by month to be written as they are.

    Lines that come without SalesKey or TotalRevenue get theirs here, where they are written: these need
    not travel, and a file's keys follow each other.
    """
    keyed = lookup_keys(lines, date, customer, product, location).na.drop(subset=FOREIGN_KEYS)
    narrow = keyed.select(
        *FOREIGN_KEYS[:-1], *[c for c in ("SalesKey", "InvoiceKey") if c in keyed.columns],
        "InvoiceNo", "Quantity", "UnitPrice", *[c for c in ("TotalRevenue",) if c in keyed.columns], "OrderQuantity",
        F.year("__day").alias("SaleYear"), F.month("__day").alias("SaleMonth"),
    )
    dealt = dealt_by(narrow, ["SaleYear", "SaleMonth"], [c for c in ("InvoiceKey",) if c in narrow.columns])
    if "TotalRevenue" not in dealt.columns:
        dealt = dealt.withColumn("TotalRevenue", revenue())
    return dealt if "SalesKey" in dealt.columns else with_sales_key(dealt)


def from_rows(rows: DataFrame, run_id: str, loaded_at: Column) -> DataFrame:
    """The sales fact from its keys and values: what is constant or follows from them is added when it is read."""
    return measures(rows.withColumn("ChannelKey", F.lit(config.CHANNEL[0])), run_id, loaded_at)


def fact_by_month(lines: DataFrame, date: DataFrame, customer: DataFrame, product: DataFrame,
                  location: DataFrame, run_id: str, loaded_at: Column) -> DataFrame:
    """The sales fact dealt by month, to be written as it is: only keys and values of a line travel."""
    return from_rows(rows_by_month(lines, date, customer, product, location), run_id, loaded_at)


def unknown_fanout(lines: DataFrame) -> DataFrame:
    """Lines as a loader sees them that holds the unknown customer twice.

    Each unknown line then matches both members, key 0 and the ordinary group,
    and is counted twice. Kept for comparing published row counts.
    """
    times = F.when(F.col("CustomerID") == config.UNKNOWN, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return lines.withColumn("__member", F.explode(times)).drop("__member")

"""Typing, filtering, reject accounting and enrichment of invoice lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart import config
from lakemart.functions.columns import season
from lakemart.functions.ranks import numbered

REJECT_RULES = [
    "cancelled_orders", "invalid_quantities", "invalid_prices",
    "missing_critical_data", "duplicates", "empty_product_info",
]


def _parsed(name: str, kind: T.DataType, parse: Column) -> Column:
    return parse if isinstance(kind, T.StringType) else F.col(name)


def typed_lines(raw: DataFrame) -> DataFrame:
    """Coerce every column; what cannot be read becomes null, never an error."""
    kinds = {f.name: f.dataType for f in raw.schema.fields}
    stamp = F.coalesce(
        F.expr("try_cast(trim(InvoiceDate) AS timestamp_ntz)"),
        F.expr("try_to_timestamp(trim(InvoiceDate), 'M/d/yyyy H:mm')").cast("timestamp_ntz"),
    ) if isinstance(kinds["InvoiceDate"], T.StringType) else F.col("InvoiceDate").cast("timestamp_ntz")
    person = F.trim(F.col("CustomerID").cast("string"))
    customer = F.when(person.contains(".0"), F.regexp_replace(person, r"\.0$", "")).otherwise(person)

    def text(name: str) -> Column:
        cleaned = F.trim(F.col(name).cast("string"))
        return F.coalesce(F.when(cleaned != "nan", cleaned), F.lit(""))

    return raw.select(
        F.col("InvoiceNo").cast("string").alias("InvoiceNo"),
        text("StockCode").alias("StockCode"),
        text("Description").alias("Description"),
        _parsed("Quantity", kinds["Quantity"], F.col("Quantity").try_cast("int")).alias("Quantity"),
        stamp.alias("InvoiceDate"),
        _parsed("UnitPrice", kinds["UnitPrice"], F.col("UnitPrice").try_cast("decimal(10,2)")).alias("UnitPrice"),
        F.coalesce(F.when(~customer.isin("", "nan"), customer), F.lit(config.UNKNOWN)).alias("CustomerID"),
        text("Country").alias("Country"),
    )


def row_reject_reason(max_quantity: int = config.MAX_QUANTITY,
                      max_price: float = config.MAX_UNIT_PRICE) -> Column:
    """First rule a single row breaks, or null. Duplicates need more than one row."""

    def outside(name: str, top) -> Column:
        return ~F.coalesce((F.col(name) > 0) & (F.col(name) <= F.lit(top)), F.lit(False))

    return (
        F.when(F.col("InvoiceNo").startswith(config.CANCEL_PREFIX), REJECT_RULES[0])
        .when(outside("Quantity", max_quantity), REJECT_RULES[1])
        .when(outside("UnitPrice", max_price), REJECT_RULES[2])
        .when(F.col("InvoiceDate").isNull(), REJECT_RULES[3])
    )


def _blank_product() -> Column:
    return (F.trim("StockCode") == "") | (F.trim("Description") == "")


def counted_lines(typed: DataFrame, **limits) -> DataFrame:
    """Every different line once, with the rule it breaks (or null) and its number of copies.

    Written once, it is the source of the clean lines, the quarantine and the funnel.
    """
    return typed.withColumn("__reason", row_reject_reason(**limits)).groupBy(*typed.columns, "__reason").agg(
        F.count(F.lit(1)).alias("__copies"))


def revenue() -> Column:
    """What a line is worth: pieces times price."""
    return (F.col("Quantity").cast("decimal(10,0)") * F.col("UnitPrice")).cast("decimal(12,2)")


def clean_from(counted: DataFrame) -> DataFrame:
    """The lines that survive every rule, from counted lines."""
    good = counted.where(F.col("__reason").isNull()).where(~_blank_product()).drop("__reason", "__copies")
    return good.withColumn("TotalRevenue", revenue()).where(F.col("TotalRevenue") > 0)


def clean_lines(typed: DataFrame, **limits) -> DataFrame:
    """Lines that survive every rule, with TotalRevenue, duplicates removed.

    The duplicate step aggregates on all columns, so copies of one row collapse
    before the shuffle.
    """
    return (
        typed.where(row_reject_reason(**limits).isNull())
        .where(~_blank_product())
        .dropDuplicates()
        .withColumn("TotalRevenue", revenue())
        .where(F.col("TotalRevenue") > 0)
    )


def rejected_lines(typed: DataFrame, **limits) -> DataFrame:
    """Quarantine: each rejected row once with its reason and the number of copies rejected."""
    return rejected_from(counted_lines(typed, **limits))


def rejected_from(counted: DataFrame) -> DataFrame:
    """Quarantine from counted lines."""
    columns = [c for c in counted.columns if c not in ("__reason", "__copies")]
    surplus = F.struct(F.lit("duplicates").alias("reject_reason"), (F.col("__copies") - 1).alias("copies"))
    empty = F.struct(F.lit("empty_product_info").alias("reject_reason"), F.lit(1).cast("bigint").alias("copies"))
    rule = F.struct(F.col("__reason").alias("reject_reason"), F.col("__copies").alias("copies"))
    found = F.when(F.col("__reason").isNotNull(), F.array(rule)).otherwise(
        F.filter(
            F.array(F.when(F.col("__copies") > 1, surplus), F.when(_blank_product(), empty)),
            lambda x: x.isNotNull(),
        )
    )
    return counted.select(*columns, F.explode(found).alias("r")).select(*columns, "r.*")


def reject_funnel(typed: DataFrame, **limits) -> DataFrame:
    """Rows lost to each rule in order, and rows kept: (step, rule, records).

    One shuffle: rows already rejected carry no key columns, so they collapse
    to one row per reason on the map side.
    """
    reason = row_reject_reason(**limits)
    keys = [F.when(F.col("__reason").isNull(), F.col(c)).alias(c) for c in typed.columns]
    counted = (
        typed.withColumn("__reason", reason)
        .groupBy("__reason", *keys)
        .agg(F.count(F.lit(1)).alias("__copies"))
    )
    return funnel_from(counted)


def funnel_from(counted: DataFrame) -> DataFrame:
    """The funnel from counted lines."""
    good = F.col("__reason").isNull()
    totals = counted.agg(
        F.sum("__copies").alias("initial_records"),
        *[F.sum(F.when(F.col("__reason") == r, F.col("__copies")).otherwise(0)).alias(r) for r in REJECT_RULES[:4]],
        F.sum(F.when(good, F.col("__copies") - 1).otherwise(0)).alias("duplicates"),
        F.count_if(good & _blank_product()).alias("empty_product_info"),
        F.count_if(good & ~_blank_product()).alias("final_records"),
    )
    names = ["initial_records", *REJECT_RULES, "final_records"]
    pairs = ", ".join(f"{i}, '{n}', CAST(coalesce({n}, 0) AS BIGINT)" for i, n in enumerate(names))
    return totals.select(F.expr(f"stack({len(names)}, {pairs}) AS (step, rule, records)"))


def with_order_quantity(lines: DataFrame, by: str | None = None) -> DataFrame:
    """Add the pieces of the whole invoice to each line.

    Sum first, then join back: the sum combines on the map side and the join
    lets adaptive execution split an invoice that holds very many lines, which
    a window over the invoice could not. Lines that lie by invoice may say how
    they are joined ``by`` (see ``with_invoice``).
    """
    totals = lines.groupBy("InvoiceNo").agg(F.sum("Quantity").cast("bigint").alias("OrderQuantity"))
    return lines.join(totals.hint(by) if by else totals, "InvoiceNo")


def with_invoice(lines: DataFrame, by: str = "merge") -> DataFrame:
    """Add the pieces of the whole invoice and a dense key for its number to each line.

    Joined as ``by`` says, never by broadcast: lines that lie by invoice can be written as they lie.
    """
    totals = lines.groupBy("InvoiceNo").agg(F.sum("Quantity").cast("bigint").alias("OrderQuantity"))
    return lines.join(numbered(totals, "InvoiceKey").hint(by), "InvoiceNo")


def with_invoice_in_place(lines: DataFrame, width: int) -> DataFrame:
    """``with_invoice`` for lines that lie by invoice in ``width`` partitions: one stage, nothing is written or moved.

    An invoice is numbered by its place among those of its partition, partitions taking turns: the
    keys are unique, and dense as far as partitions hold equally many invoices.
    """
    place = F.monotonically_increasing_id()
    turn, part = place.bitwiseAND(F.lit((1 << 33) - 1)), F.shiftright(place, 33)
    totals = lines.groupBy("InvoiceNo").agg(F.sum("Quantity").cast("bigint").alias("OrderQuantity")).withColumn(
        "InvoiceKey", turn * width + part + 1)
    return lines.join(totals.hint("shuffle_hash"), "InvoiceNo")


def with_date_parts(lines: DataFrame) -> DataFrame:
    day = F.to_date("InvoiceDate")
    weekend = F.weekday(day) >= 5
    return lines.select(
        "*",
        F.lit(1).alias("LineItemNo"),
        day.alias("InvoiceDateDate"),
        F.year(day).alias("InvoiceYear"),
        F.month(day).alias("InvoiceMonth"),
        F.quarter(day).alias("InvoiceQuarter"),
        F.weekday(day).alias("InvoiceDayOfWeek"),
        F.dayofyear(day).alias("InvoiceDayOfYear"),
        weekend.alias("IsWeekend"),
        (~weekend).alias("IsBusinessDay"),
        season(F.month(day)).alias("Season"),
        (F.month(day) == 12).alias("IsPeakSeason"),
    )


def with_customer_value(lines: DataFrame, steps=None) -> DataFrame:
    """High, medium or low value by the customer's total revenue (strictly above the step)."""
    steps = steps or config.VALUE_SEGMENTS
    value = F.lit(config.VALUE_SEGMENT_DEFAULT)
    for threshold, label in reversed(steps):
        value = F.when(F.col("__spent") > threshold, F.lit(label)).otherwise(value)
    spent = lines.groupBy("CustomerID").agg(F.sum("TotalRevenue").alias("__spent"))
    # lines without a customer share one total: it comes as a scalar, and their join key is spread
    unknown = F.col("CustomerID") == config.UNKNOWN
    spread = F.concat(F.lit(config.UNKNOWN + "#"), F.pmod(F.xxhash64("InvoiceNo", "StockCode"), F.lit(4096)))
    known = spent.where(~unknown).select(F.col("CustomerID").alias("__customer"), F.col("__spent").alias("__known"))
    shared = spent.where(unknown).agg(F.max("__spent")).scalar()
    return (
        lines.withColumn("__customer", F.when(unknown, spread).otherwise(F.col("CustomerID")))
        .join(known, "__customer", "left")
        .withColumn("__spent", F.when(unknown, shared).otherwise(F.col("__known")))
        .withColumn("CustomerSegment", value)
        .drop("__spent", "__known", "__customer")
    )


def fact_validation(fact: DataFrame, big_quantity: int = 1000, big_price: float = 1000) -> DataFrame:
    """The closing counters of the load, in one aggregate."""
    return fact.agg(
        F.count_if(F.col("TotalRevenue") <= 0).alias("invalid_revenue"),
        F.count_if(
            F.col("InvoiceNo").isNull() | F.col("Quantity").isNull() | F.col("UnitPrice").isNull()
        ).alias("missing_critical"),
        F.count_if(F.col("Quantity") > big_quantity).alias("extreme_quantity"),
        F.count_if(F.col("UnitPrice") > big_price).alias("extreme_price"),
    )

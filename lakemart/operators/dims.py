"""Dimension builders. Each returns the full dimension with its surrogate key."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemart import config
from lakemart.functions.columns import keyword_class, money, ratio, right_closed_bin, season
from lakemart.functions.ranks import dense_key, stable_key
from lakemart.session import work_dir
from lakemart.sinks.tables import write_table


def _day_count_key(df: DataFrame, natural_key: str, out: str, known: DataFrame | None = None) -> DataFrame:
    """Dense key for a calendar: one row per day, so a plain window is bounded. Known days keep their key."""
    order = Window.orderBy(natural_key)
    if known is None:
        return df.withColumn(out, F.row_number().over(order).cast("long"))
    held = known.select(natural_key, out)
    new = df.join(held.select(natural_key), natural_key, "left_anti")
    top = held.agg(F.coalesce(F.max(out), F.lit(0).cast("long"))).scalar()
    return held.unionByName(new.withColumn(out, (F.row_number().over(order) + top).cast("long")))


def dim_date(lines: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per distinct invoice day with calendar and fiscal attributes.

    FiscalQuarter keeps the published rule (calendar quarter from April on, 4 in
    January to March); FiscalQuarterApr counts April to June as quarter 1.
    """
    d = F.col("FullDate")
    month, year, weekend = F.month(d), F.year(d), F.weekday(d) >= 5
    days = lines.select(F.to_date("InvoiceDate").alias("FullDate")).where("FullDate IS NOT NULL").distinct()
    return _day_count_key(days, "FullDate", "DateKey", known).select(
        "DateKey",
        "FullDate",
        F.day(d).alias("Day"),
        month.alias("Month"),
        year.alias("Year"),
        F.quarter(d).alias("Quarter"),
        F.weekday(d).alias("DayOfWeek"),
        F.dayofyear(d).alias("DayOfYear"),
        F.weekofyear(d).alias("WeekNumber"),
        F.date_format(d, "E").alias("DayName"),
        F.date_format(d, "MMMM").alias("MonthName"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("QuarterName"),
        weekend.alias("IsWeekend"),
        F.lit(False).alias("IsHoliday"),
        (~weekend).alias("IsBusinessDay"),
        F.when(month >= 4, year).otherwise(year - 1).alias("FiscalYear"),
        F.when(month >= 4, F.quarter(d)).otherwise(F.lit(4)).alias("FiscalQuarter"),
        F.when(month >= 4, month - 3).otherwise(month + 9).alias("FiscalMonth"),
        (F.pmod(F.quarter(d) + 2, F.lit(4)) + 1).cast("int").alias("FiscalQuarterApr"),
        season(month).alias("Season"),
        (month == 12).alias("IsPeakSeason"),
    )


def dim_date_basic(lines: DataFrame) -> DataFrame:
    """The ten-attribute date dimension of the second loader."""
    return dim_date(lines).select(
        "DateKey", "FullDate", "Day", "Month", "Year", "Quarter", "DayOfWeek",
        "DayName", "MonthName", "IsWeekend", "IsHoliday",
    )


def geo_lookup(spark: SparkSession, countries: list[str] | None = None) -> DataFrame:
    rows = [g for g in config.GEO if countries is None or g[0] in countries]
    return spark.createDataFrame(rows, config.GEO_COLUMNS)


def dim_location(lines: DataFrame, geo: DataFrame | None = None, known: DataFrame | None = None) -> DataFrame:
    """One row per country with region, continent and currency where the lookup knows them."""
    geo = geo if geo is not None else geo_lookup(lines.sparkSession)
    places = stable_key(
        lines.select("Country").where("Country IS NOT NULL").distinct(), "Country", "LocationKey", known)
    unknown = F.lit("Unknown")
    return places.join(geo, "Country", "left").select(
        "LocationKey",
        "Country",
        F.coalesce("Region", unknown).alias("Region"),
        F.coalesce("Continent", unknown).alias("Continent"),
        unknown.alias("City"),
        unknown.alias("PostalCode"),
        F.lit(None).cast("decimal(10,6)").alias("Latitude"),
        F.lit(None).cast("decimal(10,6)").alias("Longitude"),
        F.lit(None).cast("decimal(15,2)").alias("GDP"),
        F.lit(None).cast("int").alias("Population"),
        F.coalesce("Currency", unknown).alias("Currency"),
        unknown.alias("TimeZone"),
        unknown.alias("MarketSize"),
        unknown.alias("MarketMaturity"),
        F.coalesce("IsPrimaryMarket", F.lit(False)).alias("IsPrimaryMarket"),
    )


def first_by_date(value: str) -> Column:
    """First value of a group by (invoice date, invoice number, value)."""
    return F.min(F.struct("InvoiceDate", "InvoiceNo", value))[value]


def _folded(lines: DataFrame, key: str, value: str, sums: dict[str, Column], merged: dict[str, Column]) -> DataFrame:
    """Per key the first ``value`` (as ``first_by_date``) and totals, in one pass that needs no sort.

    Lines fold to (key, value) with their earliest date and ``sums``; ``merged`` brings these
    together per key. Only keys of which two values share the earliest date are looked up by invoice.
    """
    at = F.coalesce(F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', InvoiceDate)"),
                    F.lit(-(1 << 62)))
    folded = lines.groupBy(key, F.col(value).alias("__value")).agg(
        F.min(at).alias("__at"), *[s.alias(name) for name, s in sums.items()])
    folded = write_table(folded, work_dir(lines.sparkSession, "dims", uuid.uuid4().hex))
    whole = folded.groupBy(key).agg(
        F.min(F.struct("__at", "__value"))["__value"].alias("__first"),
        F.max(F.struct(-F.col("__at"), "__value"))["__value"].alias("__other"),
        *[m.alias(name) for name, m in merged.items()],
    ).withColumn("__tied", ~F.col("__first").eqNullSafe(F.col("__other"))).drop("__other")
    tied = whole.where("__tied").select(key)
    if not tied.isEmpty():
        exact = lines.join(tied, key, "left_semi").groupBy(key).agg(first_by_date(value).alias("__exact"))
        whole = whole.join(exact, key, "left").withColumn(
            "__first", F.when(F.col("__tied"), F.col("__exact")).otherwise(F.col("__first"))).drop("__exact")
    return whole.withColumnRenamed("__first", value).drop("__tied")


def customer_metrics(lines: DataFrame) -> DataFrame:
    """Purchase profile per known customer. Unknown customers are left out: they
    are one member with fixed attributes, not a group to aggregate."""
    totals = _folded(lines.where(F.col("CustomerID") != config.UNKNOWN), "CustomerID", "Country", {
        "__from": F.min("InvoiceDate"), "__to": F.max("InvoiceDate"), "__dated": F.count("InvoiceDate"),
        "__revenue": F.sum("TotalRevenue"), "__priced": F.count("TotalRevenue"), "__pieces": F.sum("Quantity"),
    }, {
        "__from": F.min("__from"), "__to": F.max("__to"), "__dated": F.sum("__dated"),
        "__revenue": F.sum("__revenue"), "__priced": F.sum("__priced"), "__pieces": F.sum("__pieces"),
    })
    return totals.select(
        "CustomerID", "Country",
        F.to_date("__from").alias("FirstPurchaseDate"),
        F.to_date("__to").alias("LastPurchaseDate"),
        F.col("__dated").alias("TotalOrders"),
        money(F.col("__revenue")).alias("TotalRevenue"),
        ratio(F.col("__revenue"), F.col("__priced")).alias("AverageOrderValue"),
        F.col("__pieces").cast("bigint").alias("TotalQuantity"),
    )


def dim_customer(lines: DataFrame, as_of: Column | None = None, monetary_bins=None, tier_bins=None,
                 recency_bins=None, metrics: DataFrame | None = None, known: DataFrame | None = None) -> DataFrame:
    """Customer dimension with recency/frequency/monetary bins and the unknown member (key 0).

    ``as_of`` defaults to the newest invoice day. ``metrics`` may pass an already
    written result of ``customer_metrics``; members of ``known`` keep their keys.
    """
    metrics = metrics if metrics is not None else customer_metrics(lines)
    if as_of is None:
        as_of = lines.agg(F.to_date(F.max("InvoiceDate"))).scalar()
    keyed = stable_key(metrics, "CustomerID", "CustomerKey", known)
    recency = F.datediff(as_of, F.col("LastPurchaseDate"))
    profiled = keyed.withColumn("CustomerRecency", recency)
    recency_bin = right_closed_bin(F.col("CustomerRecency"), *(recency_bins or config.RECENCY_BINS))
    monetary_bin = right_closed_bin(F.col("TotalRevenue"), *(monetary_bins or config.MONETARY_BINS))
    status = (
        F.when(F.col("CustomerRecency") > config.CHURNED_DAYS, "Churned")
        .when(F.col("CustomerRecency") > config.INACTIVE_DAYS, "Inactive")
        .otherwise("Active")
    )
    known = profiled.select(
        "CustomerKey",
        "CustomerID",
        "Country",
        F.lit(None).cast("string").alias("Region"),
        F.lit(None).cast("string").alias("Continent"),
        F.lit(None).cast("string").alias("City"),
        F.concat_ws("_", F.coalesce(recency_bin, F.lit("nan")), F.coalesce(monetary_bin, F.lit("nan")))
        .alias("CustomerSegment"),
        right_closed_bin(F.col("TotalRevenue"), *(tier_bins or config.TIER_BINS)).alias("CustomerTier"),
        recency_bin.alias("RecencySegment"),
        right_closed_bin(F.col("TotalOrders"), *config.FREQUENCY_BINS).alias("FrequencySegment"),
        monetary_bin.alias("MonetarySegment"),
        F.col("TotalRevenue").alias("CustomerLifetimeValue"),
        "CustomerRecency",
        F.col("TotalOrders").alias("CustomerFrequency"),
        F.col("TotalRevenue").alias("CustomerMonetary"),
        "FirstPurchaseDate",
        "LastPurchaseDate",
        "TotalOrders",
        "TotalRevenue",
        "AverageOrderValue",
        "TotalQuantity",
        F.lit("Unknown").alias("AgeGroup"),
        F.lit("Unknown").alias("Gender"),
        (status == "Active").alias("IsActive"),
        status.alias("CustomerStatus"),
    )
    return unknown_member(known).unionByName(known)


def unknown_member(like: DataFrame) -> DataFrame:
    """The one-row unknown customer in the schema of the given dimension."""
    fixed = {
        "CustomerKey": F.lit(0), "CustomerID": F.lit(config.UNKNOWN), "Country": F.lit(config.UNKNOWN),
        "IsActive": F.lit(False),
    }
    unknown_text = {
        "CustomerSegment", "CustomerTier", "RecencySegment", "FrequencySegment", "MonetarySegment",
        "AgeGroup", "Gender", "CustomerStatus",
    }
    zero = {
        "TotalOrders", "TotalRevenue", "AverageOrderValue", "TotalQuantity", "CustomerFrequency",
        "CustomerMonetary", "CustomerLifetimeValue",
    }

    def value(name: str) -> Column:
        if name in fixed:
            return fixed[name]
        if name in unknown_text:
            return F.lit("Unknown")
        return F.lit(0) if name in zero else F.lit(None)

    return like.sparkSession.range(1).select(*[
        value(f.name).cast(f.dataType).alias(f.name) for f in like.schema.fields
    ])


def dim_customer_basic(lines: DataFrame, steps=None) -> DataFrame:
    """Customer dimension of the second loader: value segment, totals, no unknown member."""
    value = F.lit(config.VALUE_SEGMENT_DEFAULT)
    for threshold, label in reversed(steps or config.VALUE_SEGMENTS):
        value = F.when(F.col("TotalRevenue") > threshold, F.lit(label)).otherwise(value)
    metrics = _folded(lines, "CustomerID", "Country", {
        "__from": F.min("InvoiceDate"), "__to": F.max("InvoiceDate"), "__revenue": F.sum("TotalRevenue"),
        "__pieces": F.sum("Quantity"),
    }, {
        "__from": F.min("__from"), "__to": F.max("__to"), "__revenue": F.sum("__revenue"), "__pieces": F.sum("__pieces"),
    }).select(
        "CustomerID", "Country",
        F.to_date("__from").alias("FirstPurchaseDate"),
        F.to_date("__to").alias("LastPurchaseDate"),
        money(F.col("__revenue")).alias("TotalRevenue"),
        F.col("__pieces").cast("bigint").alias("TotalQuantity"),
    )
    return dense_key(metrics, "CustomerID", "CustomerKey").select(
        "CustomerKey", "CustomerID", "Country", value.alias("CustomerSegment"), "FirstPurchaseDate",
        "LastPurchaseDate", "TotalRevenue", "TotalQuantity",
        F.lit(True).alias("IsActive"), F.lit("Active").alias("CustomerStatus"),
    )


def _product_totals(lines: DataFrame) -> DataFrame:
    """Per product its first description, sums, counts and price range."""
    sums, ends = ("TotalRevenue", "Quantity", "UnitPrice"), {"__low": F.min, "__high": F.max}
    totals = {f"{kind}{c}": fn(c) for c in sums for kind, fn in (("__sum", F.sum), ("__count", F.count))}
    return _folded(lines, "StockCode", "Description", {**totals, **{name: fn("UnitPrice") for name, fn in ends.items()}},
                   {**{name: F.sum(name) for name in totals}, **{name: fn(name) for name, fn in ends.items()}})


def product_metrics(lines: DataFrame, lie_by: str | None = None) -> DataFrame:
    """Sales profile per product. Of lines that lie by ``lie_by`` (InvoiceNo) orders are told apart where they lie."""
    def mean(c: str) -> Column:
        return ratio(F.col(f"__sum{c}"), F.col(f"__count{c}"))

    # an invoice's dense key says the same as its number in fewer bytes; the pairs are counted on their own
    invoice = lie_by or ("InvoiceKey" if "InvoiceKey" in lines.columns else "InvoiceNo")
    orders = lines.where(F.col(invoice).isNotNull()).select("StockCode", invoice).distinct().groupBy(
        F.col("StockCode").alias("__code")).agg(F.count(F.lit(1)).alias("__orders"))
    totals = _product_totals(lines)
    return totals.join(orders, totals["StockCode"].eqNullSafe(F.col("__code")), "left").select(
        "StockCode",
        F.coalesce(F.trim("Description"), F.lit("")).alias("Description"),
        money(F.col("__sumTotalRevenue")).alias("TotalRevenue"),
        mean("TotalRevenue").alias("AverageRevenue"),
        F.col("__sumQuantity").cast("bigint").alias("TotalQuantitySold"),
        mean("Quantity").alias("AverageOrderQuantity"),
        mean("UnitPrice").alias("AveragePrice"),
        F.col("__low").alias("MinPrice"),
        F.col("__high").alias("MaxPrice"),
        F.coalesce("__orders", F.lit(0).cast("long")).alias("UniqueOrders"),
    )


def dim_product(lines: DataFrame, classes=None, metrics: DataFrame | None = None,
                known: DataFrame | None = None) -> DataFrame:
    """Product dimension: sales profile, keyword classes, assumed cost and margin."""
    metrics = metrics if metrics is not None else product_metrics(lines)
    grade = keyword_class(
        F.col("Description"), classes or config.PRODUCT_CLASSES, config.PRODUCT_DEFAULT, config.PRODUCT_EMPTY
    )
    price, cost = F.col("AveragePrice"), F.col("AveragePrice") * config.COST_SHARE
    unknown, nothing = F.lit("Unknown"), F.lit(None)
    keyed = stable_key(metrics, "StockCode", "ProductKey", known).withColumn("__class", grade)
    return keyed.select(
        "ProductKey",
        "StockCode",
        "Description",
        F.col("__class.col1").alias("ProductCategory"),
        F.col("__class.col2").alias("ProductSubcategory"),
        unknown.alias("ProductBrand"),
        F.col("__class.col3").alias("ProductLine"),
        price.alias("StandardPrice"),
        cost.alias("CostPrice"),
        F.round((price - cost) / price * 100, 2).alias("ProfitMargin"),
        unknown.alias("ProductSize"),
        unknown.alias("ProductColor"),
        unknown.alias("ProductMaterial"),
        nothing.cast("decimal(8,2)").alias("ProductWeight"),
        "TotalQuantitySold",
        "TotalRevenue",
        "AverageRevenue",
        "AverageOrderQuantity",
        "MinPrice",
        "MaxPrice",
        "UniqueOrders",
        F.lit(True).alias("IsActive"),
        F.lit("Active").alias("ProductStatus"),
        nothing.cast("date").alias("LaunchDate"),
        nothing.cast("date").alias("DiscontinuationDate"),
    )


def dim_product_basic(lines: DataFrame, classes=None) -> DataFrame:
    """Product dimension of the second loader: five classes, price range, totals."""
    metrics = _product_totals(lines).select(
        "StockCode", "Description",
        ratio(F.col("__sumUnitPrice"), F.col("__countUnitPrice")).alias("AvgPrice"),
        F.col("__low").alias("MinPrice"),
        F.col("__high").alias("MaxPrice"),
        money(F.col("__sumTotalRevenue")).alias("TotalRevenue"),
        F.col("__sumQuantity").cast("bigint").alias("TotalQuantity"),
    )
    grade = keyword_class(F.col("Description"), classes or config.BASIC_CLASSES, config.BASIC_DEFAULT, "Unknown")
    return dense_key(metrics, "StockCode", "ProductKey").select(
        "ProductKey", "StockCode", "Description", grade.alias("ProductCategory"), "AvgPrice", "MinPrice",
        "MaxPrice", "TotalRevenue", "TotalQuantity",
        F.lit(True).alias("IsActive"), F.lit("Active").alias("ProductStatus"),
    )


def dim_channel(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([config.CHANNEL], config.CHANNEL_COLUMNS).withColumn(
        "LaunchDate", F.col("LaunchDate").cast("date")
    )

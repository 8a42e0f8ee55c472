"""Model features from the star. All are plain aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart import config
from lakemart.functions.columns import dbl, mean_of, sample_std
from lakemart.functions.ranks import exact_quantiles
from lakemart.operators.kpi import known_only, sales
from lakemart.operators.profile import value_counts


def ml_sales(star) -> DataFrame:
    """Sales with their calendar day, for the models."""
    return sales(star, date=("FullDate",)).select(
        "InvoiceNo", F.col("FullDate").alias("InvoiceDate"), "CustomerKey", "ProductKey", "Quantity",
        "UnitPrice", "TotalRevenue",
    )


def ml_customers(star) -> DataFrame:
    """Known customers with their profile."""
    return known_only(star.customer).select(
        "CustomerKey", "CustomerID", "Country", "CustomerSegment", "CustomerLifetimeValue", "CustomerRecency",
        "CustomerFrequency", "CustomerMonetary", "FirstPurchaseDate", "LastPurchaseDate", "TotalOrders",
        "TotalRevenue", "AverageOrderValue",
    )


def segmentation_features(star, as_of: Column) -> DataFrame:
    """Six features per known customer: recency, frequency, monetary, sizes, lifespan."""
    grouped = known_only(ml_sales(star)).groupBy("CustomerKey").agg(
        F.min("InvoiceDate").alias("__first"),
        F.max("InvoiceDate").alias("__last"),
        F.count("InvoiceDate").alias("Frequency"),
        F.sum("TotalRevenue").alias("__revenue"),
        F.sum("Quantity").cast("bigint").alias("__pieces"),
        F.countDistinct("InvoiceNo").alias("__orders"),
    )
    orders = F.col("__orders")
    return grouped.select(
        "CustomerKey",
        F.datediff(as_of, "__last").alias("Recency"),
        "Frequency",
        dbl("__revenue").alias("Monetary"),
        F.coalesce(F.try_divide(dbl("__pieces"), dbl(orders)), F.lit(0.0)).alias("AvgOrderSize"),
        F.coalesce(F.try_divide(dbl("__revenue"), dbl(orders)), F.lit(0.0)).alias("RevenuePerOrder"),
        F.datediff("__last", "__first").alias("CustomerLifespan"),
    )


def churn_features(customers: DataFrame, as_of: Column, threshold_days: int = 90) -> DataFrame:
    """Churn label (no purchase for longer than the threshold) and twelve features."""
    aged = customers.withColumn("__days", F.datediff(as_of, "LastPurchaseDate"))
    grouped = aged.groupBy("CustomerKey").agg(
        F.coalesce(dbl(F.sum("TotalRevenue")), F.lit(0.0)).alias("TotalRevenue_Sum"),
        F.coalesce(mean_of("TotalRevenue"), F.lit(0.0)).alias("TotalRevenue_Mean"),
        F.coalesce(sample_std("TotalRevenue"), F.lit(0.0)).alias("TotalRevenue_Std"),
        F.coalesce(dbl(F.sum("TotalOrders")), F.lit(0.0)).alias("TotalOrders_Sum"),
        F.coalesce(mean_of("TotalOrders"), F.lit(0.0)).alias("TotalOrders_Mean"),
        F.coalesce(mean_of("CustomerRecency"), F.lit(0.0)).alias("AvgRecency"),
        F.coalesce(mean_of("CustomerFrequency"), F.lit(0.0)).alias("AvgFrequency"),
        F.coalesce(mean_of("CustomerMonetary"), F.lit(0.0)).alias("AvgMonetary"),
        F.coalesce(mean_of("__days"), F.lit(0.0)).alias("DaysSinceLastPurchase"),
        F.max(F.when(F.col("__days") > threshold_days, 1).otherwise(0)).alias("IsChurned"),
    )
    return grouped.select(
        "*",
        (F.col("TotalRevenue_Mean") / (F.col("TotalRevenue_Std") + 1)).alias("RevenueTrend"),
        F.coalesce(F.try_divide(F.col("TotalOrders_Sum"), F.col("AvgRecency") + 1), F.lit(0.0)).alias("OrderFrequency"),
        (F.col("TotalRevenue_Sum") / (F.col("TotalOrders_Sum") + 1)).alias("ValuePerOrder"),
    )


def churn_columns(drop_leak: bool = False) -> list[str]:
    """Feature list; ``drop_leak`` leaves out the columns the label is made of."""
    leaks = {"DaysSinceLastPurchase", "AvgRecency", "OrderFrequency"}
    return [c for c in config.CHURN_FEATURES if not (drop_leak and c in leaks)]


def invoice_features(sales_rows: DataFrame) -> DataFrame:
    """Thirteen features per invoice for anomaly detection."""
    grouped = sales_rows.groupBy("InvoiceNo").agg(
        dbl(F.sum("TotalRevenue")).alias("TotalRevenue_Sum"),
        mean_of("TotalRevenue").alias("TotalRevenue_Mean"),
        F.coalesce(sample_std("TotalRevenue"), F.lit(0.0)).alias("TotalRevenue_Std"),
        dbl(F.sum("Quantity")).alias("Quantity_Sum"),
        mean_of("Quantity").alias("Quantity_Mean"),
        F.coalesce(sample_std("Quantity"), F.lit(0.0)).alias("Quantity_Std"),
        mean_of("UnitPrice").alias("UnitPrice_Mean"),
        F.coalesce(sample_std("UnitPrice"), F.lit(0.0)).alias("UnitPrice_Std"),
        F.countDistinct("CustomerKey").alias("UniqueCustomers"),
        F.countDistinct("ProductKey").alias("UniqueProducts"),
    )
    return grouped.select(
        "*",
        (F.col("TotalRevenue_Sum") / (F.col("Quantity_Sum") + 1)).alias("RevenuePerItem"),
        (F.col("Quantity_Sum") / (F.col("UniqueCustomers") + 1).cast("double")).alias("ItemsPerCustomer"),
        F.col("UniqueProducts").alias("ProductsPerOrder"),
    )


def filled_days(days: DataFrame, values: list[str], by: list[str] | None = None) -> DataFrame:
    """Add the days missing between the first and the last, with zero values.

    Each day also emits the empty days up to the next one, so nothing is joined
    or scanned twice. A window partition holds one row per calendar day.
    """
    by = by or []
    following = F.lead("Date").over(Window.partitionBy(*by).orderBy("Date"))
    reach = days.withColumn("__last", F.coalesce(F.date_sub(following, 1), F.col("Date")))
    spread = reach.withColumn("__day", F.explode(F.sequence("Date", "__last")))
    present = F.col("__day") == F.col("Date")
    zero = {v: F.when(present, F.col(v)).otherwise(F.lit(0).cast(days.schema[v].dataType)).alias(v) for v in values}
    return spread.select(*by, F.col("__day").alias("Date"), *zero.values())


def daily_series(sales_rows: DataFrame) -> DataFrame:
    """Revenue, pieces, orders and customers per day, days without sales as zero."""
    days = sales_rows.groupBy(F.col("InvoiceDate").alias("Date")).agg(
        dbl(F.sum("TotalRevenue")).alias("Revenue"),
        F.sum("Quantity").cast("bigint").alias("Quantity"),
        F.countDistinct("InvoiceNo").alias("Orders"),
        F.countDistinct("CustomerKey").alias("Customers"),
    )
    return filled_days(days, ["Revenue", "Quantity", "Orders", "Customers"])


def resampled(series: DataFrame, unit: str) -> DataFrame:
    """Weekly or monthly sums of a daily series ('week', 'month'); daily uniques add up."""
    return series.groupBy(F.to_date(F.date_trunc(unit, "Date")).alias("Date")).agg(
        F.sum(F.col("Revenue").cast("decimal(22,2)")).cast("double").alias("Revenue"),
        *[F.sum(c).cast("bigint").alias(c) for c in ("Quantity", "Orders", "Customers")],
    )


def standardized(df: DataFrame, columns: list[str], suffix: str = "_scaled") -> DataFrame:
    """Zero mean and unit population deviation per column (constant columns only shift).

    Mean and deviation are scalar subqueries of one aggregate.
    """
    stats = df.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns])
    packed = stats.select(F.struct(*columns)).scalar()
    held = df.withColumn("__stats", packed)
    return held.select(
        *df.columns,
        *[
            ((F.col(c) - F.col(f"__stats.{c}.m"))
             / F.when(F.col(f"__stats.{c}.s") > 0, F.col(f"__stats.{c}.s")).otherwise(1.0)).alias(f"{c}{suffix}")
            for c in columns
        ],
    )


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles per feature, as numbers: one row per feature.

    One pass for the moments, one for the quartiles of all features.
    """
    def moments(c: str) -> Column:
        value = F.col(c).cast("double")
        return F.struct(F.lit(c).alias("feature"), F.count(c).alias("count"), F.avg(value).alias("mean"),
                        sample_std(c).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"))

    rows = df.agg(F.array(*[moments(c) for c in columns]).alias("rows")).select(F.explode("rows").alias("r")).select("r.*")
    quartiles = exact_quantiles(value_counts(df, columns, "double"), "v", [0.25, 0.5, 0.75], ["column_name"], weight="n").select(
        F.col("column_name").alias("feature"), F.col("q0").alias("q25"), F.col("q1").alias("q50"), F.col("q2").alias("q75"))
    return rows.join(quartiles, "feature", "left")

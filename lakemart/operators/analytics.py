"""Business reports: RFM, lifetime value, products, seasons, markets, cohorts, insights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart import config
from lakemart.functions.columns import dbl, first_at_least, mean_of
from lakemart.functions.distinct import aggregate
from lakemart.functions.ranks import exact_quantiles
from lakemart.operators.kpi import by_month, known_only, places_of, sales


def _purchases(star) -> DataFrame:
    """Sales of known customers with the calendar day, without the customer dimension."""
    return known_only(sales(star, date=("FullDate",)))


def _rfm_segment() -> Column:
    r, f, m = F.col("RecencyScore"), F.col("FrequencyScore"), F.col("MonetaryScore")
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r >= 3) & (f >= 3) & (m >= 3), "Loyal Customers")
        .when((r >= 4) & (f <= 2) & (m >= 3), "Potential Loyalists")
        .when((r >= 3) & (f >= 2) & (m <= 2), "New Customers")
        .when((r >= 3) & (f <= 2) & (m <= 2), "Promising")
        .when((r <= 2) & (f >= 3) & (m >= 3), "Need Attention")
        .when((r <= 2) & (f >= 2) & (m >= 2), "About to Sleep")
        .when((r <= 2) & (f <= 2) & (m >= 3), "At Risk")
        .when((r <= 2) & (f <= 2) & (m <= 2), "Cannot Lose Them")
        .otherwise("Others")
    )


def _scores(cuts: list) -> list[tuple]:
    return [(cut, 5 - i) for i, cut in enumerate(cuts)]


def rfm(star, as_of: Column, recency_days=None, frequency=None, monetary=None) -> DataFrame:
    """Recency, frequency and monetary scores and the segment of each known customer.

    The fact is reduced to one row per customer before the customer dimension
    is joined.
    """
    metrics = _purchases(star).groupBy("CustomerKey").agg(
        F.max("FullDate").alias("LastPurchaseDate"),
        F.countDistinct("InvoiceNo").alias("Frequency"),
        F.sum("TotalRevenue").alias("__monetary"),
        mean_of("TotalRevenue").alias("AvgOrderValue"),
    )
    recency = None
    for i, days in enumerate(recency_days or config.RFM_RECENCY_DAYS):
        fresh = F.col("LastPurchaseDate") >= F.date_sub(as_of, days)
        recency = F.when(fresh, 5 - i) if recency is None else recency.when(fresh, 5 - i)
    scored = metrics.select(
        "*",
        recency.otherwise(1).alias("RecencyScore"),
        first_at_least(F.col("Frequency"), _scores(frequency or config.RFM_FREQUENCY), 1).alias("FrequencyScore"),
        first_at_least(F.col("__monetary"), _scores(monetary or config.RFM_MONETARY), 1).alias("MonetaryScore"),
    )
    who = star.customer.select("CustomerKey", "CustomerID", "Country", "CustomerSegment")
    return (
        scored.join(who, "CustomerKey")
        .select(
            "CustomerKey", "CustomerID", "Country", "CustomerSegment", "LastPurchaseDate", "Frequency",
            dbl("__monetary").alias("Monetary"), "AvgOrderValue", "RecencyScore", "FrequencyScore",
            "MonetaryScore",
            (F.col("RecencyScore") + F.col("FrequencyScore") + F.col("MonetaryScore")).alias("RFMScore"),
            _rfm_segment().alias("RFMSegment"),
        )
        .orderBy(F.desc("RFMScore"), "CustomerKey")
    )


def _exact_mean(col: str) -> Column:
    """Mean of a two-place money value held as double, from its exact sum."""
    return F.sum(F.col(col).cast("decimal(22,2)")).cast("double") / F.count(col)


def rfm_summary(rfm_rows: DataFrame) -> DataFrame:
    return rfm_rows.groupBy("RFMSegment").agg(
        F.count("CustomerKey").alias("CustomerCount"),
        F.round(_exact_mean("Monetary"), 2).alias("AvgMonetary"),
        F.round(F.sum("Frequency").cast("double") / F.count("Frequency"), 2).alias("AvgFrequency"),
    )


def clv(star, tiers=None) -> DataFrame:
    """Lifetime value of each known customer: yearly revenue, order rhythm, tier."""
    metrics = _purchases(star).groupBy("CustomerKey").agg(
        F.countDistinct("InvoiceNo").alias("TotalOrders"),
        F.sum("TotalRevenue").alias("__revenue"),
        mean_of("TotalRevenue").alias("AvgOrderValue"),
        F.min("FullDate").alias("FirstPurchaseDate"),
        F.max("FullDate").alias("LastPurchaseDate"),
        F.countDistinct("FullDate").alias("ActiveDays"),
    )
    years = F.datediff("LastPurchaseDate", "FirstPurchaseDate").cast("double") / 365.0
    revenue, days = dbl("__revenue"), F.col("ActiveDays")
    valued = metrics.withColumn("CustomerLifespanYears", years).select(
        "*",
        F.when(F.col("CustomerLifespanYears") > 0, revenue / F.col("CustomerLifespanYears"))
        .otherwise(revenue).alias("AnnualRevenue"),
        F.when(days > 0, F.col("TotalOrders").cast("double") / (days.cast("double") / 30.0))
        .otherwise(0.0).alias("MonthlyOrderFrequency"),
        first_at_least(F.col("__revenue"), tiers or config.CLV_TIERS, config.CLV_DEFAULT).alias("CustomerTier"),
    )
    who = star.customer.select("CustomerKey", "CustomerID", "Country")
    return (
        valued.join(who, "CustomerKey")
        .select(
            "CustomerKey", "CustomerID", "Country", "TotalOrders", revenue.alias("TotalRevenue"),
            "AvgOrderValue", "FirstPurchaseDate", "LastPurchaseDate", "CustomerLifespanYears", "ActiveDays",
            "AnnualRevenue", "MonthlyOrderFrequency", "CustomerTier",
        )
        .orderBy(F.desc("TotalRevenue"), "CustomerKey")
    )


def clv_summary(clv_rows: DataFrame) -> DataFrame:
    return clv_rows.groupBy("CustomerTier").agg(
        F.count("CustomerKey").alias("CustomerCount"),
        F.round(_exact_mean("TotalRevenue"), 2).alias("AvgRevenue"),
        F.sum(F.col("TotalRevenue").cast("decimal(22,2)")).cast("double").alias("SumRevenue"),
        F.round(F.avg("MonthlyOrderFrequency"), 2).alias("AvgOrderFrequency"),
    )


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram between the smallest and the largest value.

    The bounds are scalar subqueries, so they reach the scan as constants.
    """
    low, high = df.agg(F.min(column)).scalar(), df.agg(F.max(column)).scalar()
    width = (F.col("hi") - F.col("lo")) / bins
    position = F.when(width > 0, F.floor((F.col("v") - F.col("lo")) / width)).otherwise(0)
    bounded = df.where(F.col(column).isNotNull()).select(
        F.col(column).cast("double").alias("v"), low.cast("double").alias("lo"), high.cast("double").alias("hi")
    )
    return (
        bounded.groupBy((F.least(position, F.lit(bins - 1)) + 1).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("records"), F.min("v").alias("smallest"), F.max("v").alias("largest"))
        .orderBy("bin")
    )


def box_stats(df: DataFrame, column: str, by: str) -> DataFrame:
    """Five-number summary and fences per group, with exact quartiles."""
    ends = df.groupBy(by).agg(
        F.count(column).alias("records"), F.min(column).alias("smallest"), F.max(column).alias("largest")
    )
    q1, q3 = F.col("q0"), F.col("q2")
    return ends.join(exact_quantiles(df.select(by, column), column, [0.25, 0.5, 0.75], [by]), by).select(
        by, "records", "smallest", q1.alias("q1"), F.col("q1").alias("median"), q3.alias("q3"), "largest",
        (q1 - (q3 - q1) * 1.5).alias("lower_fence"), (q3 + (q3 - q1) * 1.5).alias("upper_fence"),
    )


def _per_month(amount: Column) -> Column:
    days = F.col("ActiveDays").cast("double")
    return (
        F.when((days > 0) & (days < 365), amount * 30.0 / days)
        .when(days >= 365, amount * 30.0 / 365.0)
        .otherwise(amount)
    )


def product_performance(star, grades=None) -> DataFrame:
    """Sales rhythm, lifecycle stage and grade of every product with revenue.

    OrdersPerCustomer is a whole-number division, as published.
    """
    metrics = aggregate(sales(star, date=("FullDate",)), ["ProductKey"], [
        F.sum("Quantity").cast("bigint").alias("TotalQuantity"),
        F.sum("TotalRevenue").alias("__revenue"),
        mean_of("UnitPrice").alias("AvgUnitPrice"),
        F.min("FullDate").alias("FirstSaleDate"),
        F.max("FullDate").alias("LastSaleDate"),
    ], {"TotalOrders": "InvoiceKey", "UniqueCustomers": "CustomerKey", "ActiveDays": "DateKey"})
    revenue, pieces = dbl("__revenue"), F.col("TotalQuantity").cast("double")
    stage = F.lit(config.LIFECYCLE_DEFAULT)
    for days, name in reversed(config.LIFECYCLE):
        stage = F.when(F.col("ActiveDays") <= days, name).otherwise(stage)
    grade = F.lit(config.PRODUCT_GRADE_DEFAULT)
    for least_revenue, least_orders, name in reversed(grades or config.PRODUCT_GRADES):
        reached = (F.col("__revenue") >= least_revenue) & (F.col("TotalOrders") >= least_orders)
        grade = F.when(reached, name).otherwise(grade)
    goods = star.product.select(
        "ProductKey", "StockCode", "Description", F.col("ProductCategory").alias("OriginalCategory")
    )
    return (
        metrics.where(F.col("__revenue") > 0)
        .join(goods, "ProductKey")
        .select(
            "ProductKey", "StockCode", "Description", "OriginalCategory", "TotalOrders", "TotalQuantity",
            revenue.alias("TotalRevenue"), "AvgUnitPrice", "UniqueCustomers", "ActiveDays", "FirstSaleDate",
            "LastSaleDate",
            _per_month(pieces).alias("MonthlyQuantity"),
            _per_month(revenue).alias("MonthlyRevenue"),
            F.expr("IF(UniqueCustomers > 0, TotalOrders div UniqueCustomers, 0)").cast("bigint")
            .alias("OrdersPerCustomer"),
            F.when(pieces > 0, revenue / pieces).otherwise(0.0).alias("RevenuePerUnit"),
            F.when(F.col("ActiveDays") > 0, revenue / F.col("ActiveDays").cast("double"))
            .otherwise(0.0).alias("DailyRevenue"),
            stage.alias("LifecycleStage"),
            grade.alias("ProductCategory"),
        )
        .orderBy(F.desc("TotalRevenue"), "ProductKey")
    )


def product_category_summary(products: DataFrame) -> DataFrame:
    """Products per grade with revenue and monthly means (six places)."""
    return products.groupBy("ProductCategory").agg(
        F.count("ProductKey").alias("ProductCount"),
        F.sum(F.col("TotalRevenue").cast("decimal(22,2)")).cast("double").alias("TotalRevenue"),
        F.round(_exact_mean("TotalRevenue"), 2).alias("AvgRevenue"),
        F.round(F.avg("MonthlyRevenue"), 4).alias("AvgMonthlyRevenue"),
        F.round(F.avg("MonthlyQuantity"), 4).alias("AvgMonthlyQuantity"),
    )


def product_value_counts(products: DataFrame) -> DataFrame:
    """Products per grade and per lifecycle stage: (attribute, value, products)."""
    pairs = F.array(
        F.struct(F.lit("ProductCategory").alias("attribute"), F.col("ProductCategory").alias("value")),
        F.struct(F.lit("LifecycleStage").alias("attribute"), F.col("LifecycleStage").alias("value")),
    )
    return (
        products.select(F.explode(pairs).alias("p"))
        .groupBy("p.attribute", "p.value")
        .agg(F.count(F.lit(1)).alias("products"))
        .orderBy("attribute", F.desc("products"), "value")
    )


def product_meaningful(products: DataFrame) -> DataFrame:
    """How many products carry usable monthly figures, and their ranges."""
    q, r = F.col("MonthlyQuantity"), F.col("MonthlyRevenue")
    return products.agg(
        F.count(F.lit(1)).alias("total_products"),
        F.count_if((q > 1) & (r > 1)).alias("above_one"),
        F.count_if((q > 0) | (r > 0)).alias("above_zero"),
        F.count_if(q == 0).alias("zero_quantity"),
        F.count_if(r == 0).alias("zero_revenue"),
        F.min(q).alias("min_quantity"),
        F.max(q).alias("max_quantity"),
        F.min(r).alias("min_revenue"),
        F.max(r).alias("max_revenue"),
    )


def product_top(products: DataFrame, k: int = 50) -> DataFrame:
    """The k products with most monthly revenue among those above one piece and one unit of money."""
    return (
        products.where((F.col("MonthlyQuantity") > 1) & (F.col("MonthlyRevenue") > 1))
        .orderBy(F.desc("MonthlyRevenue"), "ProductKey")
        .limit(k)
        .select("StockCode", "Description", "MonthlyQuantity", "MonthlyRevenue", "UniqueCustomers",
                "ProductCategory", "TotalOrders", "LifecycleStage")
    )


def _breadth() -> list[Column]:
    return [
        F.sum("Quantity").cast("bigint").alias("TotalQuantity"),
        F.sum("TotalRevenue").alias("__revenue"),
        mean_of("TotalRevenue").alias("AvgOrderValue"),
    ]


BREADTH_COUNTS = {"TotalOrders": "InvoiceKey", "UniqueCustomers": "CustomerKey", "UniqueProducts": "ProductKey"}


def seasonal(star) -> DataFrame:
    return (
        by_month(star, _breadth(), BREADTH_COUNTS, "MonthName", "Quarter")
        .withColumn("TotalRevenue", dbl("__revenue"))
        .drop("__revenue")
        .orderBy("Year", "Month")
    )


def geographic(star, markets=None) -> DataFrame:
    return (
        aggregate(star.fact, ["LocationKey"], _breadth(), BREADTH_COUNTS, tops=star.tops, groups=places_of(star))
        .join(star.location.select("LocationKey", "Country", "Region", "Continent"), "LocationKey")
        .withColumn("TotalRevenue", dbl("__revenue"))
        .withColumn("MarketSegment", first_at_least(F.col("__revenue"), markets or config.MARKETS, config.MARKET_DEFAULT))
        .drop("__revenue", "LocationKey")
        .orderBy(F.desc("TotalRevenue"), "Country")
    )


def _customer_months(star) -> DataFrame:
    """One row per customer and purchase month with the customer's first month.

    The distinct step comes first, so the window sees at most one row per
    calendar month and customer however many lines a customer has.
    """
    months = (
        known_only(sales(star, date=("Year", "Month")))
        .select("CustomerKey", (F.col("Year") * 12 + F.col("Month") - 1).alias("month"))
        .distinct()
    )
    return months.withColumn("first_month", F.min("month").over(Window.partitionBy("CustomerKey"))).select(
        "CustomerKey",
        F.format_string("%04d-%02d", F.floor(F.col("first_month") / 12), F.col("first_month") % 12 + 1)
        .alias("CohortMonth"),
        (F.col("month") - F.col("first_month")).cast("int").alias("PeriodNumber"),
    )


def cohort_literal(star) -> DataFrame:
    """The cohort report as published: only period 0 passes its size filter."""
    return (
        _customer_months(star)
        .groupBy("CohortMonth", "PeriodNumber")
        .agg(
            F.count("CustomerKey").alias("Customers"),
            F.count_if(F.col("PeriodNumber") == 0).alias("CohortSize"),
        )
        .where("CohortSize > 0")
        .orderBy("CohortMonth", "PeriodNumber")
    )


def cohort_retention(star) -> DataFrame:
    """Customers of each cohort active in each later month, with the retention rate."""
    active = _customer_months(star).groupBy("CohortMonth", "PeriodNumber").agg(F.count("CustomerKey").alias("Customers"))
    size = F.max(F.when(F.col("PeriodNumber") == 0, F.col("Customers"))).over(Window.partitionBy("CohortMonth"))
    return (
        active.withColumn("CohortSize", size)
        .withColumn("RetentionRate", F.col("Customers").cast("double") / F.col("CohortSize"))
        .orderBy("CohortMonth", "PeriodNumber")
    )


def insights(rfm_rows: DataFrame, clv_rows: DataFrame, products: DataFrame, markets: DataFrame) -> DataFrame:
    """The headline numbers of four reports: (section, metric, value, text)."""
    nothing = F.lit(None).cast("string")

    def rows(df: DataFrame, section: str, metrics: list[tuple[str, Column]], text: dict | None = None) -> DataFrame:
        one = df.agg(*[c.cast("double").alias(n) for n, c in metrics], *[c.alias(n) for n, c in (text or {}).items()])
        packed = [
            F.struct(F.lit(section).alias("section"), F.lit(n).alias("metric"), F.col(n).alias("value"),
                     nothing.alias("text"))
            for n, _ in metrics
        ] + [
            F.struct(F.lit(section).alias("section"), F.lit(n).alias("metric"), F.lit(None).cast("double").alias("value"),
                     F.col(n).alias("text"))
            for n in (text or {})
        ]
        return one.select(F.explode(F.array(*packed)).alias("r")).select("r.*")

    n = F.count(F.lit(1))
    top = F.max(F.struct("TotalRevenue", "Country"))["Country"]
    return (
        rows(rfm_rows, "rfm", [
            ("total_customers", n),
            ("champions", F.count_if(F.col("RFMSegment") == "Champions")),
            ("at_risk", F.count_if(F.col("RFMSegment") == "At Risk")),
            ("new_customers", F.count_if(F.col("RFMSegment") == "New Customers")),
            ("avg_rfm_score", F.sum("RFMScore").cast("double") / n),
        ])
        .unionByName(rows(clv_rows, "clv", [
            ("avg_clv", _exact_mean("TotalRevenue")),
            ("premium_customers", F.count_if(F.col("CustomerTier") == "Premium")),
            ("avg_order_frequency", F.round(F.avg("MonthlyOrderFrequency"), 6)),
        ]))
        .unionByName(rows(products, "products", [
            ("total_products", n),
            ("star_products", F.count_if(F.col("ProductCategory") == "Star")),
            ("top_product_revenue", F.max("TotalRevenue")),
            ("avg_product_revenue", _exact_mean("TotalRevenue")),
        ]))
        .unionByName(rows(markets, "geography", [
            ("total_countries", n),
            ("major_markets", F.count_if(F.col("MarketSegment") == "Major Market")),
            ("top_country_revenue", F.max("TotalRevenue")),
        ], {"top_country": top}))
    )

"""Dashboard key figures over the star. Each takes a Star and an optional Filters."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions.columns import dbl, mean_of
from lakemart.functions.distinct import MONTHS, aggregate


def _sum(col: str, name: str):
    return dbl(F.sum(col)).alias(name)


def _pieces(name: str):
    return F.sum("Quantity").cast("bigint").alias(name)


def _distinct(col: str, name: str):
    return F.countDistinct(col).alias(name)


@dataclass(frozen=True)
class Filters:
    """Value lists and a date range; an empty list means no restriction."""

    countries: tuple[str, ...] = ()
    segments: tuple[str, ...] = ()
    categories: tuple[str, ...] = ()
    start: str | None = None
    end: str | None = None


NO_FILTER = Filters()


def sales(star, filters: Filters = NO_FILTER, date=(), customer=(), product=(), location=()) -> DataFrame:
    """The fact joined to the dimensions a report needs and to no other.

    Every fact key resolves, so an inner join to a dimension of which neither a
    column nor a filter is used would not change the rows. The arguments name
    the attributes wanted of each dimension. Year and month of a date range also
    filter the fact's partition columns.
    """
    out = star.fact
    if filters.start or filters.end:
        low = F.lit(filters.start or "0001-01-01").cast("date")
        high = F.lit(filters.end or "9999-12-31").cast("date")
        month = F.col("SaleYear") * 12 + F.col("SaleMonth")
        out = out.where(month.between(F.year(low) * 12 + F.month(low), F.year(high) * 12 + F.month(high)))
        date = tuple(dict.fromkeys([*date, "FullDate"]))
    if filters.countries:
        location = tuple(dict.fromkeys([*location, "Country"]))
    if filters.segments:
        customer = tuple(dict.fromkeys([*customer, "CustomerSegment"]))
    if filters.categories:
        product = tuple(dict.fromkeys([*product, "ProductCategory"]))

    if date:
        days = star.date.select("DateKey", *date)
        if filters.start or filters.end:
            days = days.where(F.col("FullDate").between(low, high))
        out = out.join(days, "DateKey")
    if location:
        places = star.location
        if filters.countries:
            places = places.where(F.col("Country").isin(*filters.countries))
        out = out.join(places.select("LocationKey", *location), "LocationKey")
    if product:
        goods = star.product
        if filters.categories:
            goods = goods.where(F.col("ProductCategory").isin(*filters.categories))
        wanted = [c for c in product if c != "TotalRevenue"]
        out = out.join(goods.select("ProductKey", *wanted), "ProductKey")
    if customer:
        people = star.customer
        if filters.segments:
            people = people.where(F.col("CustomerSegment").isin(*filters.segments))
        renamed = [F.col(c).alias("CustomerCountry") if c == "Country" else F.col(c) for c in customer]
        out = out.join(people.select("CustomerKey", *renamed), "CustomerKey")
    return out


def places_of(star) -> int:
    """Number of locations, where the star tells it; else more than bitmaps could serve."""
    return star.tops.get("LocationKey", 1 << 40)


def known_only(df: DataFrame) -> DataFrame:
    """Without the unknown customer (key 0), filtered on the fact itself."""
    return df.where(F.col("CustomerKey") != 0)


def global_kpis(star) -> DataFrame:
    return aggregate(star.fact, [], [
        _sum("TotalRevenue", "TotalRevenue"),
        _pieces("TotalQuantity"),
        dbl(F.round(F.sum("TotalRevenue") / F.count("TotalRevenue"), 2)).alias("AvgTransactionValue"),
    ], {"UniqueCustomers": "CustomerKey", "UniqueProducts": "ProductKey", "TotalOrders": "InvoiceKey"}, tops=star.tops)


def overview(star, filters: Filters = NO_FILTER) -> DataFrame:
    return aggregate(sales(star, filters), [], [
        _pieces("TotalQuantity"),
        _sum("TotalRevenue", "TotalRevenue"),
        mean_of("TotalRevenue").alias("AvgOrderValue"),
    ], {"TotalOrders": "InvoiceKey", "UniqueCustomers": "CustomerKey", "UniqueProducts": "ProductKey"}, tops=star.tops)


def by_month(star, aggregates: list, distinct: dict[str, str], *names: str) -> DataFrame:
    """Aggregates of the fact per Year and Month, from its own month columns; other calendar names join the result."""
    months = aggregate(star.fact, ["SaleYear", "SaleMonth"], aggregates, distinct, tops=star.tops, groups=MONTHS)
    calendar = star.date.select("Year", "Month", *names).distinct()
    same = (F.col("SaleYear") == F.col("Year")) & (F.col("SaleMonth") == F.col("Month"))
    return months.join(calendar, same).select("Year", "Month", *names, *[c for c in months.columns if not c.startswith("Sale")])


def monthly(star) -> DataFrame:
    months = by_month(star, [_sum("TotalRevenue", "MonthlyRevenue"), _pieces("TotalQuantity")],
                      {"NumOrders": "InvoiceKey", "NumCustomers": "CustomerKey"}, "MonthName")
    return months.select(
        "Year", "Month", "MonthName", "MonthlyRevenue", "NumOrders", "TotalQuantity", "NumCustomers",
    ).orderBy("Year", "Month")


def monthly_filtered(star, filters: Filters = NO_FILTER) -> DataFrame:
    return (
        sales(star, filters, date=("Year", "Month", "MonthName"))
        .groupBy("Year", "Month", "MonthName")
        .agg(_sum("TotalRevenue", "MonthlyRevenue"), _distinct("InvoiceNo", "MonthlyOrders"))
        .orderBy("Year", "Month")
    )


def segments(star, filters: Filters = NO_FILTER) -> DataFrame:
    """Customers, revenue and mean revenue by segment. Sums per customer first, so the
    customer dimension meets one row per customer and never the fact."""
    per_customer = sales(star, replace(filters, segments=())).groupBy("CustomerKey").agg(
        F.sum("TotalRevenue").alias("__revenue"), F.count("TotalRevenue").alias("__lines"))
    people = star.customer.where(F.col("CustomerSegment").isNotNull())
    if filters.segments:
        people = people.where(F.col("CustomerSegment").isin(*filters.segments))
    return (
        per_customer.join(people.select("CustomerKey", "CustomerSegment"), "CustomerKey")
        .groupBy("CustomerSegment")
        .agg(
            F.count(F.lit(1)).alias("CustomerCount"),
            dbl(F.sum("__revenue")).alias("TotalRevenue"),
            (F.sum("__revenue").cast("double") / F.sum("__lines")).alias("AvgRevenue"),
        )
        .orderBy(F.desc("TotalRevenue"), "CustomerSegment")
    )


def top_customers(star, filters: Filters = NO_FILTER, k: int = 20) -> DataFrame:
    """Best customers by revenue. Aggregates by key first and looks the names up
    for the k winners only, unless a segment filter needs the dimension before."""
    ranked = (
        known_only(sales(star, filters))
        .groupBy("CustomerKey")
        .agg(
            _distinct("InvoiceNo", "TotalOrders"),
            F.sum("TotalRevenue").alias("__revenue"),
            mean_of("TotalRevenue").alias("AvgOrderValue"),
        )
        .orderBy(F.desc("__revenue"), "CustomerKey")
        .limit(k)
    )
    names = star.customer.select("CustomerKey", "CustomerID", "Country", "CustomerSegment")
    return (
        ranked.join(names, "CustomerKey")
        .select("CustomerID", "Country", "CustomerSegment", "TotalOrders",
                dbl("__revenue").alias("TotalRevenue"), "AvgOrderValue")
        .orderBy(F.desc("TotalRevenue"), "CustomerID")
    )


def top_products_filtered(star, filters: Filters = NO_FILTER, k: int = 20) -> DataFrame:
    ranked = (
        sales(star, filters)
        .groupBy("ProductKey")
        .agg(
            _distinct("InvoiceNo", "TotalOrders"),
            _pieces("TotalQuantity"),
            F.sum("TotalRevenue").alias("__revenue"),
            mean_of("UnitPrice").alias("AvgUnitPrice"),
        )
        .orderBy(F.desc("__revenue"), "ProductKey")
        .limit(k)
    )
    names = star.product.select("ProductKey", "StockCode", "Description", "ProductCategory")
    return (
        ranked.join(names, "ProductKey")
        .select("StockCode", "Description", "ProductCategory", "TotalOrders", "TotalQuantity",
                dbl("__revenue").alias("TotalRevenue"), "AvgUnitPrice")
        .orderBy(F.desc("TotalRevenue"), "StockCode")
    )


def categories(star, filters: Filters = NO_FILTER) -> DataFrame:
    return (
        sales(star, filters, product=("ProductCategory",))
        .where(F.col("ProductCategory").isNotNull())
        .groupBy("ProductCategory")
        .agg(
            _distinct("ProductKey", "ProductCount"),
            _sum("TotalRevenue", "TotalRevenue"),
            mean_of("TotalRevenue").alias("AvgRevenue"),
        )
        .orderBy(F.desc("TotalRevenue"), "ProductCategory")
    )


def countries(star, filters: Filters = NO_FILTER) -> DataFrame:
    """One row per country. The fact is folded on its location key; names are looked up after."""
    places = aggregate(sales(star, filters), ["LocationKey"], [_sum("TotalRevenue", "TotalRevenue")],
                       {"TotalOrders": "InvoiceKey", "UniqueCustomers": "CustomerKey"}, tops=star.tops, groups=places_of(star))
    names = star.location.select("LocationKey", "Country", "Region", "Continent")
    return places.join(names, "LocationKey").drop("LocationKey").orderBy(F.desc("TotalRevenue"), "Country")


def regions(star, filters: Filters = NO_FILTER) -> DataFrame:
    return (
        sales(star, filters, location=("Country", "Region", "Continent"))
        .where(F.col("Region").isNotNull())
        .groupBy("Region", "Continent")
        .agg(
            _distinct("Country", "CountryCount"),
            _sum("TotalRevenue", "TotalRevenue"),
            _distinct("CustomerKey", "UniqueCustomers"),
        )
        .orderBy(F.desc("TotalRevenue"), "Region", "Continent")
    )


def region_rollup(star) -> DataFrame:
    """Continent to region totals with subtotals; level 0 is a region, 3 the grand total.

    Sums per location first, so the rollup expands a few rows only.
    """
    per_place = star.fact.groupBy("LocationKey").agg(F.sum("TotalRevenue").alias("__revenue"))
    return (
        per_place.join(star.location.select("LocationKey", "Continent", "Region"), "LocationKey")
        .rollup("Continent", "Region")
        .agg(dbl(F.sum("__revenue")).alias("TotalRevenue"), F.grouping_id().cast("int").alias("Level"))
    )


def country_totals(star) -> DataFrame:
    places = aggregate(star.fact, ["LocationKey"], [_sum("TotalRevenue", "TotalRevenue"), _pieces("TotalQuantity")],
                       {"NumCustomers": "CustomerKey", "NumProducts": "ProductKey"}, tops=star.tops, groups=places_of(star))
    names = star.location.select("LocationKey", "Country")
    return places.join(names, "LocationKey").drop("LocationKey").orderBy(F.desc("TotalRevenue"), "Country")


def top_descriptions(star, k: int = 20) -> DataFrame:
    """Best product descriptions by revenue."""
    return (
        sales(star, product=("Description",))
        .where(F.col("Description").isNotNull() & (F.col("Description") != ""))
        .groupBy("Description")
        .agg(
            _sum("TotalRevenue", "TotalRevenue"),
            _pieces("TotalQuantity"),
            _distinct("InvoiceNo", "NumOrders"),
            mean_of("UnitPrice").alias("AvgPrice"),
        )
        .orderBy(F.desc("TotalRevenue"), "Description")
        .limit(k)
    )


def top_descriptions_by_quantity(star, n: int = 10, k: int = 20) -> DataFrame:
    """The n with most pieces among the k best by revenue."""
    return top_descriptions(star, k).orderBy(F.desc("TotalQuantity"), "Description").limit(n)


def customers_by_country(star) -> DataFrame:
    return (
        known_only(sales(star, customer=("Country",)))
        .groupBy(F.col("CustomerCountry").alias("Country"))
        .agg(
            _distinct("CustomerKey", "NumCustomers"),
            _sum("TotalRevenue", "TotalRevenue"),
            mean_of("TotalRevenue").alias("AvgRevenuePerCustomer"),
        )
        .orderBy(F.desc("NumCustomers"), "Country")
    )


def day_of_week(star) -> DataFrame:
    return (
        sales(star, date=("DayName", "IsWeekend", "DayOfWeek"))
        .groupBy("DayName", "IsWeekend", "DayOfWeek")
        .agg(_sum("TotalRevenue", "TotalRevenue"), _distinct("InvoiceNo", "NumOrders"))
        .orderBy("DayOfWeek")
        .drop("DayOfWeek")
    )


def date_bounds(star) -> DataFrame:
    return star.date.agg(F.min("FullDate").alias("min_date"), F.max("FullDate").alias("max_date"))


def filter_values(star) -> DataFrame:
    """Sorted value lists for the filters: (list_name, value)."""
    lists = [
        ("countries", star.location, "Country"),
        ("segments", star.customer, "CustomerSegment"),
        ("categories", star.product, "ProductCategory"),
    ]
    out = None
    for name, table, column in lists:
        one = table.where(F.col(column).isNotNull()).select(F.lit(name).alias("list_name"), F.col(column).alias("value"))
        out = one if out is None else out.unionByName(one)
    return out.distinct().orderBy("list_name", "value")


def table_counts(star) -> DataFrame:
    """Rows per table and whether no table is empty."""
    out = None
    for name, table in star.tables().items():
        one = table.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("table_name"), "records")
        out = one if out is None else out.unionByName(one)
    healthy = out.agg(F.min("records") > 0).scalar()
    return out.withColumn("healthy", healthy)


def sanity(star) -> DataFrame:
    return aggregate(star.fact, [], [F.count(F.lit(1)).alias("TotalRecords"), _sum("TotalRevenue", "TotalRevenue")],
                     {"UniqueCustomers": "CustomerKey", "UniqueProducts": "ProductKey"}, tops=star.tops)


def summary(star) -> DataFrame:
    """Rows and load times per table; dimensions carry no load time."""
    out = star.fact.agg(
        F.count(F.lit(1)).alias("RowCount"),
        F.min("LoadTimestamp").alias("FirstLoad"),
        F.max("LoadTimestamp").alias("LastLoad"),
    ).select(F.lit("FactSales").alias("TableName"), "RowCount", "FirstLoad", "LastLoad")
    nothing = F.lit(None).cast("timestamp_ntz")
    for name in ("DimDate", "DimCustomer", "DimProduct", "DimLocation"):
        out = out.unionByName(
            star.tables()[name].agg(F.count(F.lit(1)).alias("RowCount")).select(
                F.lit(name).alias("TableName"), "RowCount", nothing.alias("FirstLoad"), nothing.alias("LastLoad")
            )
        )
    return out


def at_most(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Bound for interactive display of an ordered report; without ``rows`` nothing is cut."""
    return df if rows is None else df.limit(rows)


"""Distributed generator of dirty retail lines, for load tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# an invented catalogue: things and colours make the products, prices rise by a fixed step
THINGS = ["LANTERN", "TEAPOT", "CUSHION", "NOTEBOOK", "SCARF", "BASKET", "CLOCK"]
COLOURS = ["OCHRE", "TEAL", "CORAL"]
PRODUCTS = [(f"{colour} {thing}", round(1.25 + 0.85 * i, 2))
            for i, (colour, thing) in enumerate((c, t) for t in THINGS for c in COLOURS)]
COUNTRIES = ["France", "Germany", "Spain", "Italy", "Norway", "Japan", "Canada", "Brazil", "Kenya", "India"]
FIRST_DAY = "2010-12-01"
DAYS = 374


def generate_lines(spark: SparkSession, n: int = 10_000, seed: int = 42, catalogue: list[tuple[str, float]] | None = None,
                   places: list[str] | None = None) -> DataFrame:
    """n lines: 5 % without customer, 2 % cancelled, 5 % returned, shuffled.

    ``catalogue`` lists (description, unit price), ``places`` the countries.
    Every value is a hash of (row id, column, seed), so a recomputed task
    writes the same rows.
    """

    catalogue, places = catalogue or PRODUCTS, places or COUNTRIES

    def uniform(tag: int):
        return F.pmod(F.xxhash64("id", F.lit(tag), F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))

    def pick(tag: int, low: int, high: int):
        return (F.lit(low) + F.floor(uniform(tag) * (high - low))).cast("int")

    products = F.array(*[F.struct(F.lit(c).alias("code"), F.lit(p).cast("decimal(10,2)").alias("price"))
                         for c, p in catalogue])
    countries = F.array(*[F.lit(c) for c in places])
    drawn = spark.range(n).select(
        "id",
        (uniform(1) < 0.02).alias("cancelled"),
        pick(2, 536000, 581500).cast("string").alias("invoice"),
        F.element_at(products, pick(3, 1, len(catalogue) + 1)).alias("product"),
        F.greatest(F.lit(1), F.floor(-3.0 * F.log(1.0 - uniform(4)))).cast("int").alias("pieces"),
        (uniform(5) < 0.05).alias("returned"),
        pick(6, 0, DAYS).alias("day"),
        pick(7, 8, 21).alias("hour"),
        F.when(uniform(8) >= 0.05, pick(9, 12347, 18287).cast("string")).alias("CustomerID"),
        F.element_at(countries, pick(10, 1, len(places) + 1)).alias("Country"),
    )
    when = F.date_add(F.lit(FIRST_DAY).cast("date"), F.col("day")).cast("timestamp_ntz")
    return drawn.orderBy(F.xxhash64("id", F.lit(seed))).select(
        F.when(F.col("cancelled"), F.concat(F.lit("C"), "invoice")).otherwise(F.col("invoice")).alias("InvoiceNo"),
        F.col("product.code").alias("StockCode"),
        F.col("product.code").alias("Description"),
        F.when(F.col("cancelled") | F.col("returned"), -F.col("pieces")).otherwise(F.col("pieces")).alias("Quantity"),
        (when + F.make_dt_interval(hours=F.col("hour"))).alias("InvoiceDate"),
        F.col("product.price").alias("UnitPrice"),
        "CustomerID",
        "Country",
    )

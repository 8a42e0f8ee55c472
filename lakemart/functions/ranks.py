"""Global order without a global sort task.

``running_total`` gives every row the sum of a weight over all rows up to and
including it in key order. Spark range-partitions the rows and writes them with
their partition's number; sums per partition, added up in order, are the offsets
of the totals inside each partition. There is one path for all sizes: partitions
come from the session's shuffle width, and a written row keeps its place when an
executor is lost. Dense surrogate keys and exact quantiles are both special cases.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.session import shuffle_width, work_dir


def running_total(df: DataFrame, key: str, weight: str, out: str, by: list[str] | None = None,
                  partitions: int | None = None) -> DataFrame:
    """Add ``out``: inclusive running sum of ``weight`` in ``key`` order per ``by``.

    ``key`` must be unique within ``by``. Rows are written once to the shared folder.
    """
    by = by or []
    spark = df.sparkSession
    path = work_dir(spark, "ranks", uuid.uuid4().hex)
    ranged = df.repartitionByRange(partitions or shuffle_width(spark), *by, key).withColumn(
        "__range", F.spark_partition_id())
    ranged.write.parquet(path)
    written = spark.read.schema(ranged.schema).parquet(path)

    # one row per partition and group that meet: the rows of a group lie in neighbouring partitions
    ahead = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sums = written.groupBy(*by, "__range").agg(F.sum(weight).alias("__sum"))
    offsets = sums.select(
        *[F.col(b).alias(f"__by{i}") for i, b in enumerate(by)], F.col("__range").alias("__at"),
        F.coalesce(F.sum("__sum").over(ahead), F.lit(0)).alias("__offset"),
    )
    same = F.col("__range") == F.col("__at")
    for i, b in enumerate(by):
        same = same & F.col(b).eqNullSafe(F.col(f"__by{i}"))
    local = Window.partitionBy(*by, "__range").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    return (
        written.withColumn("__local", F.sum(weight).over(local))
        .join(offsets, same)
        .withColumn(out, F.col("__local") + F.col("__offset"))
        .drop("__range", "__at", "__local", "__offset", *[f"__by{i}" for i in range(len(by))])
    )


def dense_key(df: DataFrame, natural_key: str, out: str, **options) -> DataFrame:
    """Number distinct natural keys 1..n in key order."""
    counted = running_total(df.withColumn("__one", F.lit(1).cast("long")), natural_key, "__one", "__key", **options)
    return counted.withColumn(out, F.col("__key").cast("long")).drop("__one", "__key")


def numbered(df: DataFrame, out: str) -> DataFrame:
    """Number rows 1..n in no particular order, without sorting: by their place in the partition that writes them."""
    spark = df.sparkSession
    path = work_dir(spark, "ranks", uuid.uuid4().hex)
    placed = df.withColumn("__place", F.monotonically_increasing_id())
    placed.write.parquet(path)
    written = spark.read.schema(placed.schema).parquet(path)
    part = F.shiftright("__place", 33)
    sizes = written.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    ahead = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)     # one row per partition
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__before"))
    place = F.col("__place") - F.shiftleft(part, 33)
    return written.join(offsets, part == F.col("__part")).withColumn(out, place + F.col("__before") + 1).drop(
        "__place", "__part", "__before")


def stable_key(df: DataFrame, natural_key: str, out: str, known: DataFrame | None = None) -> DataFrame:
    """Dense keys; members of ``known`` (natural key, key) keep theirs and new ones follow the largest."""
    if known is None:
        return dense_key(df, natural_key, out)
    held = known.select(natural_key, out)
    old = df.join(held, natural_key)
    new = dense_key(df.join(held.select(natural_key), natural_key, "left_anti"), natural_key, out)
    top = held.agg(F.coalesce(F.max(out), F.lit(0).cast("long"))).scalar()
    return old.unionByName(new.withColumn(out, F.col(out) + top))


def exact_quantiles(df: DataFrame, value: str, probs: list[float], by: list[str] | None = None,
                    weight: str | None = None, **options) -> DataFrame:
    """Exact linear-interpolated quantiles, one row per group, columns q0, q1, ...

    ``weight`` names a column that says how often a row counts. Rows collapse to (value, count) before the shuffle, so a value shared by a
    third of all rows costs one row; the counts are then ranked by range.
    """
    by = by or []
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).alias("__v"))
        .agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("__n"))
    )
    ranked = running_total(counts, "__v", "__n", "__upto", by, **options)
    totals = counts.groupBy(*by).agg(F.sum("__n").alias("__total"))
    if by:
        ranked = ranked.join(totals, by)
    else:
        ranked = ranked.withColumn("__total", totals.scalar())
    first = F.col("__upto") - F.col("__n")

    def holds(rank: Column) -> Column:
        return F.max(F.when((first <= rank) & (rank < F.col("__upto")), F.col("__v").cast("double")))

    picked = []
    for i, p in enumerate(probs):
        spot = (F.col("__total") - 1) * F.lit(float(p))
        picked += [
            holds(F.floor(spot)).alias(f"__lo{i}"),
            holds(F.ceil(spot)).alias(f"__hi{i}"),
            F.max(spot - F.floor(spot)).alias(f"__part{i}"),
        ]
    out = [
        (F.col(f"__lo{i}") + (F.col(f"__hi{i}") - F.col(f"__lo{i}")) * F.col(f"__part{i}")).alias(f"q{i}")
        for i in range(len(probs))
    ]
    return ranked.groupBy(*by).agg(*picked).select(*by, *out)

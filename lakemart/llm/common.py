"""Helpers shared by the text operators: table readers, staged tables, native text counts."""

from __future__ import annotations

import gc
import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.session import work_dir

# Words are maximal runs of anything but these six characters.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A folder below the shared one that no other call uses."""
    return work_dir(spark, "llm", f"{name}-{uuid.uuid4().hex}")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of steps whose frames are gone; it does so when the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def words(text: Column) -> Column:
    """Array of the words of a text; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def range_index(key: Column, bounds: list) -> Column:
    """Number of sorted ``bounds`` at or below the key: first among every n-th bound, then inside that stretch."""
    if not bounds:
        return F.lit(0)
    width = max(1, math.isqrt(len(bounds)))
    whole, tops = F.lit(bounds), F.lit(bounds[::width])
    start = F.greatest(F.size(F.filter(tops, lambda b: b <= key)) - 1, F.lit(0)) * width
    return start + F.size(F.filter(F.slice(whole, start + 1, F.lit(width)), lambda b: b <= key))

"""Structured Streaming jobs that share the batch expressions."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators import cleanse, fact, quality
from lakemart.session import work_dir


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None,
                bytes_per_batch: int = 4 << 30) -> DataFrame:
    """Files of a Parquet table as a stream; a micro-batch is bounded by bytes, or by files where asked."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        return reader.option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return reader.option("maxBytesPerTrigger", bytes_per_batch).parquet(path)


def with_event_time(stream: DataFrame, column: str, watermark: str) -> DataFrame:
    """Event time as timestamp with its watermark (local timestamps cannot carry one)."""
    return stream.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, watermark)


def run_dir(spark: SparkSession, name: str) -> str:
    return work_dir(spark, "stream", f"{name}-{uuid4().hex}")


def drain_append(stream: DataFrame, name: str, root: str | None = None) -> DataFrame:
    """Process what is there into a Parquet table and return the table; a ``root`` used before is taken up again."""
    spark, root = stream.sparkSession, root or run_dir(stream.sparkSession, name)
    started = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", f"{root}/checkpoint").option("path", f"{root}/table")
        .trigger(availableNow=True).start()
    )
    started.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/table")


def drain_upsert(stream: DataFrame, name: str, keys: list[str], progress: list | None = None) -> DataFrame:
    """Process what is there in update mode and return the newest row of every key.

    Each micro-batch writes its changed rows under its number, so a replay replaces
    them; state is dropped behind the watermark. ``progress`` collects the progress reports.
    """
    spark, root = stream.sparkSession, run_dir(stream.sparkSession, name)

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/table/batch={batch_id}")

    started = (
        stream.writeStream.outputMode("update").option("checkpointLocation", f"{root}/checkpoint")
        .foreachBatch(put).trigger(availableNow=True).start()
    )
    started.awaitTermination()
    if progress is not None:
        progress += started.recentProgress
    schema = T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])
    changes = spark.read.schema(schema).parquet(f"{root}/table")
    values = [c for c in stream.columns if c not in keys]
    newest = changes.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("__row"))
    return newest.select(*keys, "__row.*").select(*stream.columns)


def cleansed(raw: DataFrame) -> DataFrame:
    """The stateless part of the cleansing: typing, row rules, revenue. Works on a stream and on a table."""
    revenue = (F.col("Quantity").cast("decimal(10,0)") * F.col("UnitPrice")).cast("decimal(12,2)")
    return (
        cleanse.typed_lines(raw)
        .where(cleanse.row_reject_reason().isNull())
        .where((F.trim("StockCode") != "") & (F.trim("Description") != ""))
        .withColumn("TotalRevenue", revenue)
        .where(F.col("TotalRevenue") > 0)
    )


def deduplicated(stream: DataFrame, time: str, keys: list[str], watermark: str = "1 hour") -> DataFrame:
    """First row of each key within the watermark; state is dropped after it."""
    return with_event_time(stream, time, watermark).dropDuplicatesWithinWatermark(keys)


def enriched(lines: DataFrame, star) -> DataFrame:
    """Streaming lines with the keys of the written dimensions."""
    return fact.lookup_keys(lines, star.date, star.customer, star.product, star.location)


def windowed(stream: DataFrame, time: str, value: str, width: str = "1 hour", slide: str | None = None,
             watermark: str = "1 hour") -> DataFrame:
    """Events and value per tumbling (or sliding) window; later rows than the watermark are dropped."""
    timed = with_event_time(stream, time, watermark)
    frame = F.window(time, width, slide) if slide else F.window(time, width)
    return timed.groupBy(frame).agg(
        F.count(F.lit(1)).alias("events"), F.sum(F.col(value).cast("decimal(18,2)")).alias("total")
    ).select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        "events", F.col("total").cast("double").alias("total"),
    )


def gated_load(stream: DataFrame, rules: Callable[[DataFrame], list[dict]], table: str,
               critical_threshold: float = 0.05) -> DataFrame:
    """Check each micro-batch and load it, or put it aside whole when the gate is closed.

    A batch is written under its number, so a replay replaces it.
    """
    spark, root = stream.sparkSession, run_dir(stream.sparkSession, "gate")

    def load(batch: DataFrame, batch_id: int) -> None:
        checks = quality.evaluate(batch, table, rules(batch))
        go_on = quality.load_gate(checks, critical_threshold).first()["proceed"]
        outcome = "loaded" if go_on else "quarantined"
        batch.write.mode("overwrite").parquet(f"{root}/table/outcome={outcome}/batch={batch_id}")

    started = (
        stream.writeStream.option("checkpointLocation", f"{root}/checkpoint").foreachBatch(load)
        .trigger(availableNow=True).start()
    )
    started.awaitTermination()
    schema = T.StructType([*stream.schema.fields, T.StructField("outcome", T.StringType()),
                           T.StructField("batch", T.LongType())])
    return spark.read.schema(schema).parquet(f"{root}/table")

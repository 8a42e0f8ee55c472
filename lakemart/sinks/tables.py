"""Table sinks: replace, append, partitioned fact, JSON and CSV artefacts."""

from __future__ import annotations

import hashlib

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart import schemas

HASHED_ROWS = 500_000        # members from which on a join hashes them where they are not broadcast


def hashed(members: DataFrame) -> DataFrame:
    """The small side of a join with lines: a large one is hashed by partition, so that the lines need no sort.

    Members have one row a key, so a partition of them is small beside its lines, which stream
    past: they take neither memory nor room on disk, however many meet in a partition.
    """
    return members.hint("shuffle_hash") if members.count() > HASHED_ROWS else members


def dealt_by(df: DataFrame, partition_by: list[str], then: list[str] | None = None) -> DataFrame:
    """Rows rebalanced on the partition columns of a table to be written, each task's rows in their order.

    Adaptive execution then writes few files per partition and splits the big ones. Columns that
    are constant or follow from others are better added after this: they then neither travel nor
    are sorted, and the writer takes the order as it is. ``then`` orders the rows of a partition: like
    rows beside each other take fewer bytes.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_by]).sortWithinPartitions(*partition_by, *(then or []))


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, dealt: bool = False) -> DataFrame:
    """Replace a Parquet table and return it read back.

    A partitioned table is rebalanced on its partition columns first, unless its rows are
    ``dealt`` already (see ``dealt_by``).
    """
    writer = (dealt_by(df, partition_by) if partition_by and not dealt else df).write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _bucketed_name(path: str) -> str:
    return f"bucketed_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def write_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int, dealt: bool = False) -> DataFrame:
    """Replace a table dealt by the hash of ``keys`` into ``buckets`` files, each sorted by them; read back.

    ``dealt`` says that the rows come from ``repartition(buckets, *keys)`` and need not move again.

    A join on exactly these keys reads such a table as it lies and shuffles the other side
    only. Keys must be spread (members, digests of lines): a hot key is a hot bucket.
    """
    name = _bucketed_name(path)
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    (df if dealt else df.repartition(buckets, *keys)).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(
        *keys).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def open_bucketed(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], buckets: int) -> DataFrame:
    """A table that another session has written with ``write_bucketed``; only that session's catalog may know it."""
    name, by = _bucketed_name(path), ", ".join(f"`{k}`" for k in keys)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def save_table(df: DataFrame, database: str, name: str) -> None:
    """Replace a catalog table, keeping only its declared columns."""
    declared = schemas.conform(df, name)
    writer = declared.write.mode("overwrite").format("parquet")
    if name == "FactSales":
        writer = writer.partitionBy("SaleYear", "SaleMonth")
    writer.saveAsTable(f"{database}.{name}")


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file, or say that it is there already; the file system decides between two writers."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        out = system.create(place, False)
    except Py4JJavaError:
        if system.exists(place):
            return False
        raise
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    return True


def append_log(log: DataFrame, path: str) -> None:
    """Append quality-check or lineage rows."""
    log.write.mode("append").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """Small result frames (profiles, summaries, reports) as one JSON-lines artefact."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str, encoding: str = "ISO-8859-1") -> None:
    df.write.mode("overwrite").option("header", True).option("encoding", encoding).csv(path)


def already_loaded(spark: SparkSession, table: str, newer_than=None) -> bool:
    """True when the table exists, holds rows and, if asked, was loaded after the given time."""
    if not spark.catalog.tableExists(table):
        return False
    rows = spark.table(table)
    if newer_than is not None:
        rows = rows.where(F.col("LoadTimestamp") >= F.lit(newer_than))
    return not rows.limit(1).isEmpty()


def load_summary(tables: dict[str, DataFrame], run_id: str) -> DataFrame:
    """Rows loaded per table and in total for one run."""
    parts = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("table_name"), "records")
        parts = one if parts is None else parts.unionByName(one)
    total = parts.agg(F.sum("records").cast("bigint").alias("records")).select(
        F.lit("total_records").alias("table_name"), "records"
    )
    return parts.unionByName(total).withColumn("etl_run_id", F.lit(run_id))

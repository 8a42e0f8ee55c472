"""Session helpers: the shared working folder and sensible defaults."""

from __future__ import annotations

import gc
import tempfile

from pyspark.sql import SparkSession

_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for written tables and checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session
    (tests) may fall back to a fresh temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="lakemart-")
    return _LOCAL_DIRS[app]


def work_dir(spark: SparkSession, *parts: str) -> str:
    """A sub-folder of the shared folder that belongs to this application."""
    return "/".join([shared_dir(spark), "lakemart", spark.sparkContext.applicationId, *parts])


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of steps whose frames are gone; it does so when the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def local_session(cpus: str = "8", partitions: int = 8) -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lakemart")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )

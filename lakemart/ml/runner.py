"""Runs the analyses one after the other; one failing does not stop the rest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakemart import config
from lakemart.sinks.tables import write_table

STATUS_COLUMNS = "analysis string, status string, records bigint, message string"


def enough_rows(fact: DataFrame, least: int = config.MIN_ROWS_FOR_ML) -> bool:
    """True when the fact holds the least number of rows; reads no more than that."""
    return fact.limit(least).count() >= least


def run_all(spark: SparkSession, fact: DataFrame, analyses: dict[str, Callable[[], DataFrame]],
            least: int = config.MIN_ROWS_FOR_ML, results: str | None = None) -> DataFrame:
    """One status row per analysis: completed with its row count, failed with the error, or skipped.

    ``results`` names a folder below which every result table is written; the count then
    reads what was written.
    """
    rows = []
    ready = enough_rows(fact, least)
    for name, run in analyses.items():
        if not ready:
            rows.append((name, "skipped", 0, f"fewer than {least} fact rows"))
            continue
        try:
            made = run()
            if results:
                made = write_table(made, f"{results}/{name}")
            rows.append((name, "completed", made.count(), None))
        except Exception as error:  # noqa: BLE001 - the status row carries the error on
            rows.append((name, "failed", 0, str(error)))
    return spark.createDataFrame(rows, STATUS_COLUMNS)

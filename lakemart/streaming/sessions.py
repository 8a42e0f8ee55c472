"""Sessions of a stream with state that ends behind the watermark.

Events of a task fold into fragments first, one per user and slot as long as the gap, so a
user with very many events arrives as few rows. A stateful processor keeps each user's open
sessions and joins fragments to them; an event-time timer emits a session once the watermark
has passed its last event by the gap, and its state goes. Closed sessions are appended to a
table and never rewritten; sessions still open are read from the state.

The watermark speaks of fragments: one whose newest event is behind it is dropped, an older
event that comes in a newer fragment still counts. Nulls in user or time make no session.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from lakemart.streaming.jobs import run_dir

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
COUNTS = ["events", "views", "clicks", "purchases"]
FRAGMENT = "first_at long, last_at long, " + ", ".join(f"{c} long" for c in COUNTS)


def _longs(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.LongType()) for n in names])


def merged(parts: pd.DataFrame, gap: int) -> pd.DataFrame:
    """Fragments or sessions of one user, joined where the pause between them is shorter than the gap."""
    parts = parts.sort_values(["first_at", "last_at"], kind="stable")
    reach = parts["last_at"].cummax().shift()
    number = ((parts["first_at"] - reach) >= gap).cumsum()
    grouped = parts.groupby(number.to_numpy())
    out = grouped[COUNTS].sum()
    out.insert(0, "first_at", grouped["first_at"].min())
    out.insert(1, "last_at", grouped["last_at"].max())
    return out.astype("int64").reset_index(drop=True)


def fragments(events: DataFrame, time: str, user: str, gap_seconds: int) -> DataFrame:
    """Rows (user, first_at, last_at, counts, fragment_time) of a table or stream; times in microseconds."""
    kind = events.schema[user].dataType.simpleString()
    gap = gap_seconds * 1_000_000
    at = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', CAST(`{time}` AS TIMESTAMP_NTZ))")
    narrow = events.select(F.col(user).alias("user"), at.alias("at"), F.col("event_type").alias("kind")).where(
        "user IS NOT NULL AND at IS NOT NULL")

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["slot"] = batch["at"] // gap
            batch["events"] = 1
            for name in COUNTS[1:]:
                batch[name] = (batch["kind"] == name[:-1]).astype("int64")
            grouped = batch.groupby(["user", "slot"], sort=False)
            out = grouped[COUNTS].sum()
            out["first_at"], out["last_at"] = grouped["at"].min(), grouped["at"].max()
            yield out.reset_index()[["user", "first_at", "last_at", *COUNTS]]

    folded = narrow.mapInPandas(fold, f"user {kind}, {FRAGMENT}")
    return folded.withColumn("fragment_time", F.timestamp_micros("last_at"))


class OpenSessions(StatefulProcessor):
    """Open sessions of one user, by their first event."""

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", _longs("first_at"), _longs("last_at", *COUNTS))

    def _held(self) -> pd.DataFrame:
        rows = [(*k, *v) for k, v in self.open.iterator()] if self.open.exists() else []
        return pd.DataFrame(rows, columns=["first_at", "last_at", *COUNTS], dtype="int64")

    def _keep(self, before: pd.DataFrame, now: pd.DataFrame) -> None:
        """Change the state where it differs; one timer, for the session that ends first."""
        old = {r[0]: r[1:] for r in before.itertuples(index=False, name=None)}
        new = {r[0]: r[1:] for r in now.itertuples(index=False, name=None)}
        for first in old.keys() - new.keys():
            self.open.removeKey((int(first),))
        for first, value in new.items():
            if old.get(first) != value:
                self.open.updateValue((int(first),), tuple(map(int, value)))
        for due in list(self.handle.listTimers()):
            self.handle.deleteTimer(due)
        if new:
            self.handle.registerTimer(-(-(int(now["last_at"].min()) + self.gap) // 1000))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = now = self._held()
        for batch in rows:
            now = merged(pd.concat([now, batch[now.columns]], ignore_index=True), self.gap)
        self._keep(before, now)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self._held()
        ended = held["last_at"] + self.gap <= timerValues.getCurrentWatermarkInMs() * 1000
        self._keep(held, held[~ended])
        if ended.any():
            out = held[ended].copy()
            out.insert(0, "user", np.repeat(key[0], len(out)))
            yield out

    def close(self) -> None:
        pass


@contextmanager
def state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Stateful processors need the RocksDB state store; a query keeps the store it was started with."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def closed(stream: DataFrame, time: str, user: str, gap_seconds: int, watermark: str) -> DataFrame:
    """Sessions of a stream of events, each emitted once, when the watermark has passed its end."""
    kind = stream.schema[user].dataType.simpleString()
    parts = fragments(stream, time, user, gap_seconds).withWatermark("fragment_time", watermark)
    return parts.groupBy("user").transformWithStateInPandas(
        OpenSessions(gap_seconds * 1_000_000), f"user {kind}, {FRAGMENT}", "Append", "EventTime")


def still_open(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The sessions held in the state of a drained query."""
    state = spark.read.format("statestore").option("stateVarName", "open").load(checkpoint)
    return state.select("key.user", "user_map_key.first_at", "user_map_value.*")


def drain(stream: DataFrame, name: str, time: str, user: str, gap_seconds: int = 1800, watermark: str = "1 hour",
          root: str | None = None, progress: list | None = None) -> tuple[DataFrame, DataFrame]:
    """Process what is there: (closed sessions so far, sessions still open). A ``root`` used before is taken up again."""
    spark = stream.sparkSession
    root = root or run_dir(spark, name)
    out = closed(stream, time, user, gap_seconds, watermark)
    with state_in_rocksdb(spark):
        started = (
            out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{root}/checkpoint")
            .option("path", f"{root}/table").trigger(availableNow=True).start()
        )
        started.awaitTermination()
        if progress is not None:
            progress += started.recentProgress
        return spark.read.schema(out.schema).parquet(f"{root}/table"), still_open(spark, f"{root}/checkpoint")


def named(sessions: DataFrame, user: str) -> DataFrame:
    """Sessions with their start as a local timestamp."""
    return sessions.select(
        F.col("user").alias(user), F.timestamp_micros("first_at").cast("timestamp_ntz").alias("session_start"), *COUNTS)

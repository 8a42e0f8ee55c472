"""Streaming sessions: each closed once, state behind the watermark gone, the whole equal to the batch."""

import datetime as dt
import random

from pyspark.sql import functions as F

from lakemart.operators import aggregates
from lakemart.streaming import jobs, sessions

FIELDS = "event_id int, user_id int, ts timestamp_ntz, event_type string"
START = dt.datetime(2024, 1, 1)


def _put(spark, path, rows):
    spark.createDataFrame(rows, FIELDS).coalesce(1).write.mode("append").parquet(path)


def _rows(frame):
    return sorted(tuple(r) for r in sessions.named(frame, "user_id").collect())


def _batch(spark, path):
    whole = aggregates.sessions(spark.read.parquet(path).where("user_id IS NOT NULL AND ts IS NOT NULL"))
    return sorted(tuple(r) for r in whole.select("user_id", "session_start", *sessions.COUNTS).collect())


def test_closed_sessions_leave_the_state(spark, tmp_path):
    path, root = str(tmp_path / "events"), str(tmp_path / "stream")
    rng, seen, most = random.Random(3), [], 0
    for day in range(4):
        rows = [(i, 1 if rng.random() < .5 else rng.randint(2, 9), START + dt.timedelta(days=day, seconds=rng.randint(0, 80_000)),
                 rng.choice(["view", "click", "purchase"])) for i in range(400)]
        _put(spark, path, rows)
        progress = []
        stream = jobs.read_stream(spark, path, spark.read.parquet(path).schema)
        closed, still = sessions.drain(stream, "t", "ts", "user_id", 1800, "2 hours", root, progress)
        # what was closed before is still there, as it was
        now = _rows(closed)
        assert set(seen) <= set(now) and len(set(now)) == len(now)
        seen = now
        held = still.count()
        most = max(most, held)
        last = START + dt.timedelta(days=day, seconds=80_000)
        ends = still.agg(F.min(F.timestamp_micros("last_at").cast("timestamp_ntz"))).scalar()
        assert held and still.select(ends).first()[0] > last - dt.timedelta(hours=3)
    assert _rows(closed.unionByName(still)) == _batch(spark, path)
    # the state holds what may still grow, not the sessions of four days
    assert most < len(seen) / 8
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    assert kept[-1] < len(seen) / 2


def test_late_arrivals_join_sessions_and_nulls_make_none(spark, tmp_path):
    path = str(tmp_path / "events")
    at = lambda minutes: START + dt.timedelta(minutes=minutes)
    _put(spark, path, [(1, 1, at(0), "view"), (2, 1, at(50), "click"), (3, None, at(5), "view"), (4, 2, None, "view")])
    _put(spark, path, [(5, 1, at(25), "view"), (6, 1, at(80), "purchase"), (7, 1, at(110), "view"), (8, 3, at(1), "other")])
    stream = jobs.read_stream(spark, path, spark.read.parquet(path).schema, files_per_batch=1)
    closed, still = sessions.drain(stream, "t", "ts", "user_id", 1800, "10 days")
    got = _rows(closed.unionByName(still))
    assert got == _batch(spark, path)
    # 0, 25 and 50 minutes join over the late event; a pause of exactly the gap starts a new session
    assert got == [(1, at(0), 3, 2, 1, 0), (1, at(80), 1, 0, 0, 1), (1, at(110), 1, 1, 0, 0), (3, at(1), 1, 0, 0, 0)]


def test_no_events_give_no_sessions(spark, tmp_path):
    path = str(tmp_path / "events")
    _put(spark, path, [])
    stream = jobs.read_stream(spark, path, spark.read.parquet(path).schema)
    kinds = sessions.closed(stream, "ts", "user_id", 1800, "1 hour").dtypes
    assert kinds[0] == ("user", "int") and len(kinds) == 7

"""Exact K-means on integer vectors with ns-bounds.

Every vector keeps, per centroid, the squared distance it last measured and the round of that
measurement. A centroid's history is kept whole, so a stored distance is loosened by the norm
of the centroid's total displacement since that round, not by the sum of its steps. While the
loosened distance to every other centroid stays above that to its own, a vector keeps its
centroid unmeasured. Where a bound fails, the own distance is measured first and then
the failing centroids, in whole numbers, so assignments are those of a full scan.

Each round is one pass over a written table; tasks also write one row with the sums of their
vectors per centroid, which Spark adds up. The driver receives the summed components of the
centroids (count * (width + 3) numbers) and nothing that grows with the vectors. A round's
table is deleted once the next one is written; a lost executor repeats tasks over written files.

Defined results: vectors of another width, null vectors and vectors with null or non-finite
components are left out; repeated rows are vectors of their own; a null id starts a centroid
only where other ids do not suffice; equal start keys are ordered by the vector; fewer
vectors than centroids give fewer centroids; a centroid without vectors stays where it is;
no vectors give no rows. A component of 2**17 or more is refused with an error, since
distances would leave the range of a long. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import fresh_path

SCALE = 1024
LARGEST = 1 << 27           # of a scaled component
MARGIN = 1e-9               # relative; far above the rounding of square roots and norms
STATE = "vec_id {kind}, vec binary, cluster int, distance long, seen binary, near binary, sums array<bigint>"
COLUMNS = ["vec_id", "vec", "cluster", "distance", "seen", "near", "sums"]


def _quantized(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            kept = batch.filter(pc.fill_null(pc.equal(pc.list_value_length(lists), width), False))
            flat = pc.cast(kept.column("embedding").flatten(), pa.float64())
            x = flat.fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, width)
            whole = np.isfinite(x).all(axis=1)
            x = np.floor(SCALE * x[whole])
            if x.size and np.abs(x).max() >= LARGEST:
                raise ValueError("component too large: squared distances would not fit a long")
            ids = kept.column("vec_id").filter(pa.array(whole))
            vectors = pa.array([v.tobytes() for v in x.astype("<i4")], pa.binary())
            yield pa.RecordBatch.from_arrays([ids, vectors], names=["vec_id", "vec"])
    return run


def quantized(rows: DataFrame, width: int) -> DataFrame:
    """(vec_id, vec) of the vectors that count: floor(1024 * x) per component, 32-bit little-endian."""
    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.select("vec_id", "embedding").mapInArrow(_quantized(width), f"vec_id {kind}, vec binary")


def _matrix(column: pa.Array, kind: str, width: int) -> np.ndarray:
    """Rows of a binary column of equal lengths as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(-1, width)


class Pass:
    """One round over batches of vectors against the newest centroids of ``history``."""

    def __init__(self, history: np.ndarray):
        self.now = len(history) - 1
        self.centroids = history[-1]
        gaps = (history - history[-1]).astype(np.float64)
        # displacement of every centroid since every round, never below the true norm
        self.moved = np.sqrt((gaps * gaps).sum(axis=2)).T * (1 + MARGIN)
        self.measured = 0

    def distances(self, vectors: np.ndarray, which: np.ndarray | int) -> np.ndarray:
        """Exact squared distances."""
        self.measured += len(vectors)
        gap = vectors.astype(np.int64) - self.centroids[which]
        return np.einsum("ij,ij->i", gap, gap)

    def first(self, vectors: np.ndarray):
        """Every distance measured."""
        near = np.stack([self.distances(vectors, j) for j in range(len(self.centroids))], axis=1)
        return near.argmin(axis=1), np.full(near.shape, self.now, "<u2"), near

    def assign(self, vectors: np.ndarray, own: np.ndarray, seen: np.ndarray, near: np.ndarray, exact: bool):
        """New centroid of every vector; bounds that fail are measured anew, in place."""
        n, k = near.shape
        rows = np.arange(n)
        moved = self.moved[np.arange(k)[None, :], seen]
        root = np.sqrt(near.astype(np.float64))
        low = root * (1 - MARGIN) - moved
        low[rows, own] = np.inf
        reach = root[rows, own] * (1 + MARGIN) + moved[rows, own]
        loose = np.flatnonzero(((low.min(axis=1) <= reach) | exact) & (seen[rows, own] != self.now))
        near[loose, own[loose]] = self.distances(vectors[loose], own[loose])
        seen[loose, own[loose]] = self.now
        reach[loose] = np.sqrt(near[loose, own[loose]].astype(np.float64)) * (1 + MARGIN)
        fails = low <= reach[:, None]
        found = np.where(fails, np.int64(0), np.iinfo(np.int64).max)
        found[rows, own] = near[rows, own]
        for j in range(k):
            at = np.flatnonzero(fails[:, j])
            near[at, j] = found[at, j] = self.distances(vectors[at], j)
            seen[at, j] = self.now
        stays = ~fails.any(axis=1)
        return np.where(stays, own, found.argmin(axis=1))


def _round(history: np.ndarray, first: bool, last: bool):
    k, width = history.shape[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = Pass(history)
        sums = np.zeros((k, width + 3), dtype=np.int64)      # components, vectors, distances, measurements
        kind = None
        for batch in batches:
            kind = batch.column("vec_id").type
            n = batch.num_rows
            if not n:
                continue
            vectors = _matrix(batch.column("vec"), "<i4", width)
            if first:
                own, seen, near = step.first(vectors)
            else:
                seen = _matrix(batch.column("seen"), "<u2", k).copy()
                near = _matrix(batch.column("near"), "<i8", k).copy()
                own = step.assign(vectors, batch.column("cluster").to_numpy().astype(np.int64), seen, near, last)
            for j in range(k):
                at = own == j
                sums[j, :width] += vectors[at].sum(axis=0, dtype=np.int64)
                sums[j, width] += at.sum()
                sums[j, width + 1] += near[at, j].sum()
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), batch.column("vec"), pa.array(own.astype(np.int32)),
                pa.array(near[np.arange(n), own]),       # measured in this round in the last one, else a bound's base
                pa.array([x.tobytes() for x in seen], pa.binary()), pa.array([x.tobytes() for x in near], pa.binary()),
                pa.nulls(n, pa.list_(pa.int64())),
            ], names=COLUMNS)
        if kind is not None:
            sums[0, width + 2] = step.measured
            yield pa.RecordBatch.from_arrays([
                pa.nulls(1, kind), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()),
                pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), pa.array([sums.ravel()], pa.list_(pa.int64())),
            ], names=COLUMNS)
    return run


def _drop(spark: SparkSession, path: str) -> None:
    """Delete a round's own table through the file system it was written to."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def _totals(state: DataFrame, k: int, width: int) -> list[list[int]]:
    """The tasks' sums added up, as whole numbers of any size."""
    parts = state.where("sums IS NOT NULL").select(F.posexplode("sums").alias("at", "part"))
    added = {r["at"]: int(r["total"]) for r in parts.groupBy("at").agg(
        F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()}
    size = width + 3
    return [[added[j * size + i] for i in range(size)] for j in range(k)]


def start_order(prefix: str) -> Column:
    return F.sha2(F.concat(F.lit(prefix), F.col("vec_id").cast("string")), 256).asc_nulls_last()


def cluster(rows: DataFrame, k: int, rounds: int, width: int, prefix: str, work: list | None = None) -> DataFrame:
    """Every vector with its centroid after ``rounds`` updates: vec_id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256.

    ``rows`` has vec_id and embedding. Centroids start as the ``k`` vectors with the smallest sha256 of ``prefix``
    and id. ``work``, if given, receives the number of distances measured in each pass.
    """
    spark = rows.sparkSession
    kind = rows.schema["vec_id"].dataType.simpleString()
    columns = f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    path = fresh_path(spark, "vectors")
    quantized(rows, width).write.parquet(path)
    state = spark.read.schema(f"vec_id {kind}, vec binary").parquet(path)
    starts = [np.frombuffer(r["vec"], "<i4") for r in state.orderBy(start_order(prefix), "vec").limit(k).collect()]
    if not starts:
        return spark.createDataFrame([], columns)
    k = len(starts)
    history = np.stack(starts).astype(np.int64)[None]
    for step in range(rounds + 1):
        after = fresh_path(spark, "rounds")
        schema = STATE.format(kind=kind)
        state.mapInArrow(_round(history, step == 0, step == rounds), schema).write.parquet(after)
        _drop(spark, path)
        path, written = after, spark.read.schema(schema).parquet(after)
        state = written.where("sums IS NULL")
        totals = _totals(written, k, width)
        if work is not None:
            work.append(totals[0][width + 2])
        if step < rounds:
            moved = [[t[i] // t[width] for i in range(width)] if t[width] else list(map(int, history[-1][j]))
                     for j, t in enumerate(totals)]
            history = np.concatenate([history, np.array(moved, dtype=np.int64)[None]])
    digests = [hashlib.sha256(",".join(map(str, map(int, c))).encode()).hexdigest() for c in history[-1]]
    inertias = [t[width + 1] for t in totals]
    own = F.col("cluster")
    return state.select(
        "vec_id", "cluster", "distance",
        F.get(F.lit(inertias).cast("array<bigint>"), own).alias("cluster_inertia"),
        F.lit(sum(inertias)).cast("long").alias("inertia"),
        F.get(F.lit(digests), own).alias("centroid_sha256"),
    )

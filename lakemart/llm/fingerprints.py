"""Document fingerprints by content-defined chunking.

A gear hash rolls over the bytes of a text; a chunk ends where the hash's upper bits
are zero. Normalised: below the wanted length more bits must be zero, above it fewer,
so lengths stay close to it. Boundaries depend on nearby bytes only and find
themselves again behind an edit. A fingerprint is the set of chunk digests, each with
its chunk's length; the likeness of two is the share of bytes of the lighter one whose
chunks the other has too.

Each text meets its successor (descending id) in one pass: ids are cut into ranges,
a range's rows are sorted in one task, and the first row of a range also goes, as a
tail, to the range before it. Nothing but one boundary per range leaves the cluster.

Defined results: a null text is empty; an empty text has an empty fingerprint, which
is like another empty one (1.0) and unlike all others (0.0); null ids come last; equal
ids are ordered by a digest of their text; a single document is its own successor.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import range_index
from lakemart.llm.kernels import Digests, stream
from lakemart.session import shuffle_width

SHORTEST, WANTED, LONGEST = 16, 48, 192
HARD_BITS, EASY_BITS = 7, 5
GEAR = (stream(256, 29) >> np.uint64(32)).astype(np.uint32)

RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """Gear hash after every byte: the last 32 bytes, each shifted once per step, by doubling."""
    h = GEAR[data]
    for step in (1, 2, 4, 8, 16):
        if len(h) <= step:
            break
        grown = h.copy()
        grown[step:] += h[:-step] << np.uint32(step)
        h = grown
    return h


def chunk_ends(data: np.ndarray) -> list[int]:
    n = len(data)
    h = gear_hashes(data)
    easy = np.flatnonzero(h >> np.uint32(32 - EASY_BITS) == 0)
    hard = (easy[h[easy] >> np.uint32(32 - HARD_BITS) == 0] + 1).tolist()
    easy = (easy + 1).tolist()
    ends, start = [], 0
    while n - start > SHORTEST:
        at = bisect_left(hard, start + SHORTEST)
        if at < len(hard) and hard[at] < start + WANTED:
            end = hard[at]
        else:
            at = bisect_left(easy, start + WANTED)
            end = easy[at] if at < len(easy) else n
            end = min(end, start + LONGEST, n)
        ends.append(end)
        start = end
    if start < n:
        ends.append(n)
    return ends


def chunks(text: str) -> dict[int, int]:
    """Digest (48 bits) to length of every distinct chunk, in order of appearance."""
    data = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
    if not len(data):
        return {}
    ends = np.array(chunk_ends(data), dtype=np.int64)
    starts = np.concatenate([[0], ends[:-1]])
    digests = (Digests(data).of(starts, ends) >> np.uint64(16)).tolist()
    return dict(zip(digests, (ends - starts).tolist()))


def written(prints: dict[int, int]) -> str:
    """Twelve hex digits of digest and two of length for each chunk."""
    return "".join([f"{digest:012x}{length:02x}" for digest, length in prints.items()])


def likeness(a: dict[int, int], b: dict[int, int]) -> float:
    if not a or not b:
        return 1.0 if not a and not b else 0.0
    shared = sum(a[x] for x in a.keys() & b.keys())
    return min(1.0, shared / min(sum(a.values()), sum(b.values())))


def edited(text: str, following: str) -> str:
    """The last half (rounded down) replaced by as many first characters of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
    held = None          # the row whose successor comes next: (id, text, chunks)
    for batch in batches:
        out = []
        for doc_id, text, tail in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "tail"))):
            if tail and held is None:
                continue
            text = text or ""
            prints = chunks(text)
            if held is not None:
                before_id, before, own = held
                changed = edited(before, text)
                changed_prints = chunks(changed)
                out.append((
                    before_id, len(before), hashlib.sha256(changed.encode("utf-8")).hexdigest(), written(own),
                    written(changed_prints), likeness(own, changed_prints), likeness(own, prints)))
            held = None if tail else (doc_id, text, prints)
        columns = list(zip(*out)) or [[]] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def fingerprint_pairs(docs: DataFrame) -> DataFrame:
    """One row per document of (doc_id, text); see RESULT for the columns."""
    spark = docs.sparkSession
    ranges = 2 * shuffle_width(spark)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long"))
    keyed = docs.select("doc_id", "text", key.alias("key"))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = keyed.agg(F.percentile_approx("key", F.array(*[F.lit(s) for s in shares]), F.lit(10 * ranges))).first()[0]
    bucket = range_index(F.col("key"), sorted(set(cuts or [])))
    # one boundary per range: its first row in descending order
    tops = sorted((r["b"], r["m"]) for r in keyed.groupBy(bucket.alias("b")).agg(F.max("key").alias("m")).collect())
    if not tops:
        return spark.createDataFrame([], RESULT)
    receivers = [b for b, _ in tops][1:] + [tops[0][0]]
    target = F.create_map(*[F.lit(x) for (_, top), to in zip(tops, receivers) for x in (top, to)])
    homes = F.array(F.struct(bucket.alias("bucket"), F.lit(False).alias("tail")))
    tail = F.array(F.struct(F.element_at(target, F.col("key")).alias("bucket"), F.lit(True).alias("tail")))
    is_top = F.col("key").isin([top for _, top in tops])
    sent = keyed.withColumn("to", F.explode(F.when(is_top, F.concat(homes, tail)).otherwise(homes))).select(
        "doc_id", "text", "key", "to.bucket", "to.tail")
    placed = sent.repartition(ranges, "bucket").sortWithinPartitions(
        "bucket", "tail", F.desc("key"), F.xxhash64("text"))
    return placed.select("doc_id", "text", "tail").mapInArrow(_pairs, RESULT)

"""Removal of repeated passages: every byte covered by a string of LENGTH bytes that starts anywhere else too.

Each window of LENGTH bytes has an anchor: the least of the digests of its GRAM-byte
substrings. Equal windows have their anchor at the same place, so windows are compared
only where anchors are equal, and one anchor speaks for a run of windows.

1. Texts give one row per anchor: its digest, the digest of the fragment that its
   windows cover, and the offsets of the windows. Equal fragments collapse to a class
   with a count before anything is compared.
2. Where an anchor has several different fragments, these are cut out of the texts once
   for a class, and the suffixes that start at the anchor, and the reversed prefixes that
   end there, are sorted (deep-shallow: multikey quicksort, then blind tries). A window
   that starts d bytes before the anchor recurs if another fragment agrees in d bytes to
   the left and LENGTH - d to the right; runs of the two sorted orders show that for all
   fragments at once, and only where a common prefix ends the answer changes.
3. An anchor with more than GROUP different fragments is not gathered: the offsets are
   halved, each half groups by the larger text its windows share and cuts its fragments
   to what its windows cover, and equal cuts collapse again. At one offset a group holds
   equal windows only, so this ends.
4. Recurring windows go back to every occurrence of their class and are merged by text.

Defined results: a null text is empty; texts below LENGTH bytes lose nothing; equal rows
(same id and text) count as two occurrences; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm import suffix_sort
from lakemart.llm.common import staged
from lakemart.llm.kernels import Digests, blocks

LENGTH = 400
GRAM = 100
GROUP = 2048
_POSITION_BITS = 20
_STRETCH = (1 << _POSITION_BITS) - LENGTH     # windows handled at once: positions fit their bits
_U = np.uint64


# --- anchors ------------------------------------------------------------------------------
def _least_positions(grams: np.ndarray, span: int) -> np.ndarray:
    """Position of the leftmost least of every ``span`` neighbours (upper digest bits decide)."""
    mask = _U((1 << _POSITION_BITS) - 1)
    keyed = (grams & ~mask) | np.arange(len(grams), dtype=_U)
    padded = np.full(-(-len(keyed) // span) * span, ~_U(0), dtype=_U)
    padded[:len(keyed)] = keyed
    table = padded.reshape(-1, span)
    onward = np.minimum.accumulate(table, axis=1).ravel()
    backward = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(keyed) - span + 1
    return (np.minimum(backward[:n], onward[span - 1:span - 1 + n]) & mask).astype(np.int64)


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> list[np.ndarray]:
    """(gram digest, fragment digest, first window, anchor - last window, anchor - first window) per anchor."""
    found = [[] for _ in range(5)]
    digests = Digests(data)
    windows = len(data) - length + 1
    for base in range(0, max(windows, 0), _STRETCH):
        many = min(_STRETCH, windows - base)
        starts = np.arange(base, base + many + length - gram)
        grams = digests.of(starts, starts + gram)
        spots = _least_positions(grams, length - gram + 1)
        first = np.flatnonzero(np.concatenate([[True], spots[1:] != spots[:-1]]))
        last = np.concatenate([first[1:], [many]]) - 1
        at = spots[first]
        for kept, values in zip(found, (
                grams[at], digests.of(base + first, base + last + length), base + first, at - last, at - first)):
            kept.append(values)
    return [np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in found]


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "tie", "gram", "frag", "first", "d1", "d2"]
    for batch in batches:
        parts, owner = [[] for _ in range(5)], []
        for low, high, data, offsets in blocks(batch.column("text")):
            for i in np.flatnonzero(np.diff(offsets) >= LENGTH):
                rows = anchors(data[offsets[i]:offsets[i + 1]])
                owner.append(np.full(len(rows[0]), low + i, dtype=np.int64))
                for kept, values in zip(parts, rows):
                    kept.append(values)
        if not owner:
            continue
        index = pa.array(np.concatenate(owner))
        gram, frag, first, d1, d2 = (np.concatenate(p) for p in parts)
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id").take(index), batch.column("tie").take(index), pa.array(gram.view(np.int64)),
            pa.array(frag.view(np.int64)), pa.array(first), pa.array(d1.astype(np.int32)),
            pa.array(d2.astype(np.int32))], names=names)


# --- fragments ----------------------------------------------------------------------------
def _cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The fragments that each text is to give."""
    names = ["core", "class", "copies", "bytes", "d1", "d2"]
    for batch in batches:
        out = []
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
            data = text.encode("utf-8")
            for w in wanted:
                start = w["first"]
                out.append((w["gram"], w["class"], w["copies"],
                            data[start:start + w["d2"] - w["d1"] + LENGTH], w["d1"], w["d2"]))
        columns = list(zip(*out)) or [[]] * 6
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def recurring(fragments: list[bytes], copies: list[int], d1: list[int], d2: list[int]) -> list[list[tuple[int, int]]]:
    """For each fragment of one group the ranges of offsets whose windows recur."""
    m = len(fragments)
    whole = [[(a, b)] if n > 1 else [] for n, a, b in zip(copies, d1, d2)]
    if m == 1:
        return whole
    right = [f[d:] for f, d in zip(fragments, d2)]
    left = [f[:d][::-1] for f, d in zip(fragments, d2)]
    order_r, shared_r = suffix_sort.sort(right)
    order_l, shared_l = suffix_sort.sort(left)
    if m == 2:
        low, high = max(LENGTH - shared_r[1], *d1), min(shared_l[1], *d2)
        return [w or ([(low, high)] if low <= high else []) for w in whole]
    shared_r, shared_l = np.array(shared_r), np.array(shared_l)
    place_r, place_l = np.empty(m, dtype=np.int64), np.empty(m, dtype=np.int64)
    place_r[order_r], place_l[order_l] = np.arange(m), np.arange(m)
    least, most = min(d1), max(d2)
    turns = np.unique(np.concatenate([[least], LENGTH - shared_r[1:], shared_l[1:] + 1]))
    turns = turns[(turns >= least) & (turns <= most)]
    ends = np.concatenate([turns[1:] - 1, [most]])
    spans: list[list[tuple[int, int]]] = [[] for _ in range(m)]
    for low, high in zip(turns.tolist(), ends.tolist()):
        # neighbours in both orders are of one kind where their common prefix is long enough
        kind_r = np.cumsum(shared_r < LENGTH - low)[place_r]
        kind_l = np.cumsum(shared_l < low)[place_l]
        _, kind, count = np.unique(kind_r * (m + 1) + kind_l, return_inverse=True, return_counts=True)
        for i in np.flatnonzero(count[kind] > 1).tolist():
            if spans[i] and spans[i][-1][1] == low - 1:
                spans[i][-1] = (spans[i][-1][0], high)
            else:
                spans[i].append((low, high))
    clipped = [[(max(a, x), min(b, y)) for a, b in s if max(a, x) <= min(b, y)] for s, x, y in zip(spans, d1, d2)]
    return [w or s for w, s in zip(whole, clipped)]


def _recurring_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Recurring offsets per class; input sorted by core, a core's rows are bounded by GROUP."""
    names = ["class", "low", "high"]
    held: list[tuple] = []

    def solved(rows: list[tuple]) -> list[tuple[int, int, int]]:
        rows = list({row[1]: row for row in rows}.values())   # rows equal in id and text gave a class twice
        spans = recurring(*[list(c) for c in list(zip(*rows))[2:]])
        return [(row[1], a, b) for row, s in zip(rows, spans) for a, b in s]

    def made(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) or [[]] * 3
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.int32()))], names=names)

    for batch in batches:
        out = []
        columns = (batch.column(c).to_pylist() for c in ("core", "class", "bytes", "copies", "d1", "d2"))
        for row in zip(*columns):
            if held and held[0][0] != row[0]:
                out += solved(held)
                held = []
            held.append(row)
        yield made(out)
    if held:
        yield made(solved(held))


def _solve(rows: DataFrame, low: int = 0, high: int = LENGTH - GRAM, group: int = GROUP) -> DataFrame:
    """(class, low, high) of recurring offsets from rows (core, class, copies, bytes, d1, d2).

    ``low`` and ``high`` bound the offsets of every row.
    """
    crowded = staged(rows.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group), "crowded")
    hot = rows.join(crowded, "core", "left_semi")
    calm = rows.join(crowded, "core", "left_anti")
    found = (
        calm.repartition("core").sortWithinPartitions("core").select("core", "class", "bytes", "copies", "d1", "d2")
        .mapInArrow(_recurring_rows, "class long, low int, high int")
    )
    if crowded.isEmpty():
        return found
    middle = (low + high) // 2
    for x, y in {(low, middle), (min(middle + 1, high), high)}:
        half = hot.where((F.col("d1") <= y) & (F.col("d2") >= x))
        a, b = F.greatest("d1", F.lit(x)), F.least("d2", F.lit(y))
        # what all windows of the half share, and what this fragment's windows of the half cover
        shared = F.substring(F.col("bytes"), F.col("d2") - x + 1, F.lit(x + LENGTH - y))
        cover = F.substring(F.col("bytes"), F.col("d2") - b + 1, b - a + LENGTH)
        cuts = half.select(
            F.xxhash64("core", F.lit(x), F.lit(y), shared).alias("core"), F.col("class").alias("member"), "copies",
            cover.alias("bytes"), a.alias("d1"), b.alias("d2"))
        cuts = staged(cuts.withColumn("class", F.xxhash64("core", "bytes", "d1", "d2")), "halves")
        merged = staged(cuts.groupBy("core", "class", "d1", "d2").agg(
            F.sum("copies").alias("copies"), F.first("bytes").alias("bytes")), "half_classes")
        inner = _solve(merged, x, y, group)
        found = found.union(inner.join(cuts.select("class", "member"), "class").select(
            F.col("member").alias("class"), "low", "high"))
    return found


# --- removal ------------------------------------------------------------------------------
def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of byte ranges."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _kept_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    for batch in batches:
        out = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            data = (text or "").encode("utf-8")
            runs = merged([(s["start"], s["end"]) for s in spans or []])
            bounds = [0, *(x for run in runs for x in run), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(bounds[::2], bounds[1::2]))
            out.append((len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept))
        columns = list(zip(*out)) or [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=["doc_id", *names])


def remove_repeats(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes of every row of (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    tied = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    marked = staged(tied.mapInArrow(
        _anchor_rows, f"doc_id {kind}, tie long, gram long, frag long, first long, d1 int, d2 int"), "anchors")
    marked = marked.withColumn("class", F.xxhash64("gram", "frag", "d1", "d2"))
    classes = marked.groupBy("gram", "class", "d1", "d2").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "tie", "first")).alias("at"))
    totals = classes.groupBy("gram").agg(F.sum("copies").alias("n"), F.count(F.lit(1)).alias("kinds")).where("n > 1")
    shared = staged(classes.join(totals, "gram"), "shared")
    wanted = shared.where("kinds > 1").groupBy("at.doc_id", "at.tie").agg(
        F.collect_list(F.struct("gram", "class", "copies", "at.first", "d1", "d2")).alias("wanted"))
    w = wanted.alias("w")
    same = tied["doc_id"].eqNullSafe(F.col("w.doc_id")) & (tied["tie"] == F.col("w.tie"))
    fragments = staged(
        tied.join(w, same).select("text", "wanted")
        .mapInArrow(_cut_rows, "core long, class long, copies long, bytes binary, d1 int, d2 int"), "fragments")
    found = _solve(fragments, group=group).union(
        shared.where("kinds = 1 AND copies > 1").select("class", F.col("d1").alias("low"), F.col("d2").alias("high")))
    found = staged(found, "recurring")
    # a window that starts d before the anchor starts at first + d2 - d
    spans = marked.join(found, "class").groupBy("doc_id", "tie").agg(F.collect_set(F.struct(
        (F.col("first") + F.col("d2") - F.col("high")).alias("start"),
        (F.col("first") + F.col("d2") - F.col("low") + LENGTH).alias("end"))).alias("spans"))
    s = spans.alias("s")
    mine = tied["doc_id"].eqNullSafe(F.col("s.doc_id")) & (tied["tie"] == F.col("s.tie"))
    return tied.join(s, mine, "left").select(tied["doc_id"], "text", "spans").mapInArrow(
        _kept_rows, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")

"""Best-fit packing of token pieces into sequences of a fixed capacity.

Pieces shorter than the capacity are packed by bulk-synchronous best fit. Pieces are range-sorted
once by size, so each has a rank in its size. A round then

1. opens sequences: pieces above every gap, largest first, become the first piece of one each. While
   there are pieces above half the capacity, which cannot share, these alone; else as many as the
   bytes of the pieces above every gap need at least;
2. range-sorts the gaps of all open sequences;
3. sweeps both orders for successors: a piece goes to the least gap that holds it. Of several
   pieces before one gap the one of highest rank (the largest) takes it, and as many more of its
   size as the gap holds; the others go on to the next gap. Equal sizes and equal gaps are
   swept as one run each, by their counts, so a sweep yields pairs of rank intervals;
4. updates the gaps, and repeats until all pieces are placed.

Only gaps move in a round. Which piece went where is resolved once, at the end: a piece finds its
interval by size and rank, and meets its sequence by the place in that interval. The driver holds
counts per size and the intervals: less than two for each of the ``capacity`` sizes in a round, some
ten to twenty rounds, whatever the number of pieces. No group is ever gathered: a size that a third
of all pieces share is one run, spread over as many ranges as its rows need.

Defined results: a null or empty text is the end token alone; repeated rows are documents
of their own; no documents give no pieces; a length outside 1..capacity is refused.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions.ranks import running_total
from lakemart.llm.bpe import SPLIT, Automaton, byte_letters
from lakemart.llm.common import staged

SEGMENT = "segment long, size int, first long, last long, each int, gap int, low long, high long"


class _Splits(Automaton):
    """The token automaton, asked at every merge whether other parts of the joined token could also meet then."""

    others = 0

    def _gadget(self, step: int, u: int, v: int, joined: int, live: set[int]) -> None:
        if not hasattr(self, "known"):
            self.known = {label: i for i, label in self.labels.items()}
        label = self.labels[joined]
        for cut in range(1, len(label)):
            left, right = self.known.get(label[:cut]), self.known.get(label[cut:])
            if (left, right) != (u, v) and left in live and right in live:
                self.others += self._walk(left, right)
        super()._gadget(step, u, v, joined, live)


def merges_by_rank(description: str) -> bool:
    """Whether joining any two neighbours whose union is a token, least id first, gives the vocabulary's own encoding.

    It does where ids grow in the order of the merges and no token can come about from other parts than its merge's,
    which the automaton of the merges decides for all texts.
    """
    parts = json.loads(description)
    model, splitter = parts["model"], parts.get("pre_tokenizer") or {}
    if parts.get("normalizer") or splitter.get("type") != "ByteLevel" or splitter.get("add_prefix_space") \
            or not splitter.get("use_regex", True) or len(parts.get("added_tokens", [])) > 1 or "merges" not in model:
        return False
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [model["vocab"]["".join(m)] for m in merges]
    if any(a >= b for a, b in zip(ids, ids[1:])) or any(model["vocab"][x] > i for m, i in zip(merges, ids) for x in m):
        return False
    try:
        return not _Splits(description).others
    except ValueError:               # added tokens with matching rules, or two merges to one token
        return False


class Encoder:
    """Token ids of texts, as bytes of little-endian 32-bit numbers, by a vocabulary of the tokenizers library.

    ``by_rank`` (see ``merges_by_rank``) allows the faster encoder that joins by rank.
    """

    def __init__(self, description: str, by_rank: bool):
        parts = json.loads(description)
        if by_rank:
            import tiktoken

            letters = byte_letters()
            added = {t["content"]: t["id"] for t in parts.get("added_tokens", [])}
            ranks = {bytes([letters[c] for c in token]): i for token, i in parts["model"]["vocab"].items() if token not in added}
            machine = tiktoken.Encoding("vocabulary", pat_str=SPLIT.pattern, mergeable_ranks=ranks, special_tokens=added)
            self.encode = lambda text: machine.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()
        else:
            from tokenizers import Tokenizer

            library = Tokenizer.from_str(description)
            library.no_truncation()
            library.no_padding()
            self.encode = lambda text: np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(description: str, by_rank: bool) -> Encoder:
    """The process's own, made once for a vocabulary."""
    name = hashlib.sha256(description.encode("utf-8")).hexdigest(), by_rank
    if name not in _encoders:
        _encoders[name] = Encoder(description, by_rank)
    return _encoders[name]


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: all but the first are full."""
    first = n % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


def token_pieces(docs: DataFrame, path: str, end: int, capacity: int, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every whole text with its end token; with
    ``keep_ids`` also the ids.

    The vocabulary file is read once and sent to the workers (a few MB, whatever the input).
    """
    with open(path, encoding="utf-8") as file:
        description = file.read()
    shared = docs.sparkSession.sparkContext.broadcast((description, merges_by_rank(description)))
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + (["ids"] if keep_ids else [])
    closing = np.array([end], "<u4").tobytes()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = encoder(*shared.value)
        for batch in batches:
            of, found, ids = [], [], []
            for i, text in enumerate(batch.column("text")):
                tokens = machine.encode(text.as_py() or "") + closing
                for piece, (start, length) in enumerate(cuts(len(tokens) // 4, capacity)):
                    own = tokens[4 * start:4 * (start + length)]
                    of.append(i)
                    found.append((piece, start, length, zlib.crc32(own)))
                    if keep_ids:
                        ids.append(np.frombuffer(own, "<u4").astype(np.int32))
            table = np.array(found, dtype=np.int64).reshape(-1, 4)
            columns = [batch.column("doc_id").take(pa.array(of, pa.int64())), pa.array(table[:, 0].astype(np.int32)),
                       *[pa.array(table[:, j]) for j in (1, 2, 3)]]
            if keep_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return docs.select("doc_id", "text").mapInArrow(rows, schema + (", ids array<int>" if keep_ids else ""))


class Sweeps:
    """Counts of waiting pieces by size and of open sequences by gap, and the intervals matched so far."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.waiting = Counter(counts)
        self.placed: Counter[int] = Counter()       # of each size, in order of rank
        self.gaps: Counter[int] = Counter()
        self.intervals: list[tuple] = []            # rows of SEGMENT

    def _take(self, size: int, n: int, each: int, gap: int, low: int, high: int) -> None:
        first = self.placed[size]
        self.placed[size] += n
        self.waiting[size] -= n
        self.intervals.append((len(self.intervals), size, first, first + n, each, gap, low, high))

    def open(self) -> list[tuple]:
        """Intervals of pieces that become the first of a sequence; their gaps are the complement."""
        most = max((g for g, n in self.gaps.items() if n), default=0)
        above = sorted((s for s, n in self.waiting.items() if n and s > most), reverse=True)
        alone = sum(self.waiting[s] for s in above if 2 * s > self.capacity)
        left = alone or -(-sum(s * self.waiting[s] for s in above) // self.capacity)
        at = len(self.intervals)
        for size in above:
            n = min(left, self.waiting[size])
            if not n:
                break
            self._take(size, n, 1, 0, 0, 0)
            self.gaps[self.capacity - size] += n
            left -= n
        return self.intervals[at:]

    def sweep(self) -> list[tuple]:
        """One sweep from the least size up: every run of gaps takes the largest pieces behind it that are left."""
        at, changed = len(self.intervals), Counter()
        behind: list[int] = []
        for value in range(1, self.capacity):
            if self.waiting[value]:
                behind.append(value)
            low, n = 0, self.gaps[value]
            while low < n and behind:
                size = behind[-1]
                each = value // size
                pieces = min(self.waiting[size], (n - low) * each)
                used = -(-pieces // each)
                self._take(size, pieces, each, value, low, low + used)
                changed[value - each * size] += used - 1
                changed[value - (pieces - each * (used - 1)) * size] += 1
                low += used
                if not self.waiting[size]:
                    behind.pop()
            self.gaps[value] -= low
        self.gaps.update(changed)
        return self.intervals[at:]


def _intervals(spark, rows: list[tuple]) -> DataFrame:
    names = [x.split()[0] for x in SEGMENT.split(", ")]
    return F.broadcast(spark.createDataFrame(pd.DataFrame(rows, columns=names), SEGMENT))


def _ranked(rows: DataFrame, by: str, key: str) -> DataFrame:
    """Rows with their rank, from 0, among those of equal ``by``."""
    one = rows.withColumn("one", F.lit(1).cast("long"))
    return running_total(one, key, "one", "rank", [by]).withColumn("rank", F.col("rank") - 1).drop("one")


def pack(items: DataFrame, capacity: int, work: list | None = None) -> DataFrame:
    """``items`` (any columns, one of them ``length``) with sequence_id and offset.

    A sequence's id is the number of its first piece. ``work``, if given, receives the number of intervals per round.
    """
    spark = items.sparkSession
    size = F.col("length").cast("int")
    checked = F.when(size.between(1, capacity), size).otherwise(
        F.raise_error(F.lit(f"length outside 1..{capacity}")).cast("int"))
    rows = staged(items.select(F.struct("*").alias("item"), checked.alias("size"),
                               F.monotonically_increasing_id().alias("row")), "pack_items")
    full = rows.where(F.col("size") == capacity).select(
        "item", F.col("row").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    ranked = staged(_ranked(rows.where(F.col("size") < capacity), "size", "row"), "pack_ranks")
    state = Sweeps({r["size"]: r["count"] for r in ranked.groupBy("size").count().collect()}, capacity)
    gaps, resolved = None, None
    while any(state.waiting.values()):
        opened = state.open()
        if opened:
            # pieces of an opened interval, by size and rank; the sizes reach the scan as a range
            new = ranked.where(F.col("size").between(min(x[1] for x in opened), max(x[1] for x in opened))).alias("d").join(
                _intervals(spark, opened).alias("i"), (F.col("d.size") == F.col("i.size"))
                & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))
            ).select(F.col("row").alias("bin"), (capacity - F.col("d.size")).alias("gap"))
            gaps = new if gaps is None else gaps.unionByName(new)
        matched = state.sweep()
        if work is not None:
            work.append(len(opened) + len(matched))
        if not matched:
            gaps = staged(gaps, "pack_gaps")
            continue
        least = min(x[5] for x in matched)
        inside = (F.col("g.gap") == F.col("i.gap")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
        place = F.col("rank") - F.col("low")
        takes = F.least(F.col("each").cast("long"), F.col("last") - F.col("first") - place * F.col("each"))
        order = _ranked(gaps, "gap", "bin")
        swept = staged(order.alias("g").join(_intervals(spark, matched).alias("i"), inside, "left").select(
            "bin", F.col("g.gap").alias("before"), "segment", place.alias("place"),
            (F.col("g.gap") - F.coalesce(takes * F.col("size"), F.lit(0))).cast("int").alias("gap")), "pack_gaps")
        found = swept.where("segment IS NOT NULL").select(
            "bin", "segment", "place", (capacity - F.col("before")).cast("long").alias("used"))
        resolved = found if resolved is None else resolved.unionByName(found)
        gaps = swept.select("bin", "gap").where(F.col("gap") > 0)
    if not state.intervals:
        return full.select("item.*", "sequence_id", "offset")
    located = ranked.alias("d").join(
        _intervals(spark, state.intervals).alias("i"), (F.col("d.size") == F.col("i.size"))
        & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))
    ).select("item", "row", F.col("d.size").alias("size"), "segment",
             F.floor((F.col("rank") - F.col("first")) / F.col("each")).alias("place"),
             ((F.col("rank") - F.col("first")) % F.col("each")).alias("turn"))
    placed = located if resolved is None else located.join(resolved, ["segment", "place"], "left")
    bin_, used = (F.lit(None).cast("long"),) * 2 if resolved is None else (F.col("bin"), F.col("used"))
    loose = placed.select("item", F.coalesce(bin_, "row").alias("sequence_id"),
                          F.coalesce(used + F.col("turn") * F.col("size"), F.lit(0)).cast("long").alias("offset"))
    return full.unionByName(loose).select("item.*", "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids: the tokens of every sequence, from packed pieces that kept their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))

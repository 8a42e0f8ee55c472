"""Join of documents whose word n-grams overlap: exact Jaccard similarity of at least ``SIMILARITY``.

1. Each text becomes a set of 64-bit shingle digests. Equal sets are one node from here on.
2. All sets are put in one global order: shingles that many documents hold come last,
   others by digest. Two similar sets share a shingle among the first quarter of both
   (prefix filter), so nodes meet by those shingles only and common passages bring
   nobody together. The order affects work, never the result.
3. A shingle's leader is its node most of whose leading shingles are shared: the text
   that copies come from. A node's home is the leader that it meets most often. The sets
   of a home come together once and all their pairs are compared but those already
   connected: components replace pairs inside large groups of copies. In a home of more than
   a block, members are compared with the leader first; only those without that link meet
   the home's blocks.
4. What links nodes of different components meets in tiles: a shingle's nodes, where these are many by size band
   (sizes in a ratio of at least the similarity lie in the same or the next band) and blocks.
   First narrow rows meet, without bitmaps: a row goes on if its shingle holds a partner of
   another component in the ratio of sizes, where the places of the shingle in both ordered
   sets leave room for the overlap needed, and both meet others by at least as many leading
   shingles as such a pair must share. Then hashed bitmaps bound the overlap of the rows left from above by bit
   counts; pairs of one component are skipped. First the best pair of every two components
   is compared, then every other pair that is still open.
5. Comparison is by intersecting the sorted arrays. Links give connected components.

The common shingles are those held by at least one document in 2 / HEAVY_SHARE, of which
there can be at most 2 / HEAVY_SHARE times the mean set size, whatever the input: that
bound is what is broadcast.

Defined results: null, empty and blank texts have empty sets, link with nothing and are
their own component; a text with one to four words is one shingle; a null id has a null
component; rows that share an id are one node; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import release, staged
from lakemart.llm.components import components
from lakemart.llm.kernels import LOWER, Digests, blocks, mixed, word_spans

SHINGLE = 5
SIMILARITY = (75, 100)     # numerator and denominator
HEAVY_SHARE = 500          # a chunk's shingle in one of so many of its documents is counted as common
HEAVY_LEAST = 8
CHUNK_SHINGLES = 1 << 21
BLOCK_ROWS = 2048          # nodes of a tile that meet in one task
BITS = 4                   # bits of a bitmap per shingle
HOME_SHARE = 10            # a home shares at least one in so many of a node's leading shingles
TILE_UNIT = 1 << 16        # rows handled at once
_U = np.uint64
_CHAIN = _U(0x9FB21C651E98DF25)
TOP, BOTTOM = SIMILARITY


# --- sets -------------------------------------------------------------------------
def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(digests, rows) of all shingles of a block of texts, rows ascending, repeats included."""
    starts, ends, rows = word_spans(LOWER[data], offsets)
    word = Digests(LOWER[data]).of(starts, ends)
    n = len(word)
    counts = np.bincount(rows, minlength=len(offsets) - 1)
    chained = np.zeros(n, dtype=_U)
    out, at = [], []
    # texts with fewer words than a shingle: their whole sequence, chained up to its length
    for k in range(size):
        moved = np.zeros(n, dtype=_U)
        moved[:n - k] = word[k:] if k else word
        chained = mixed(chained * _CHAIN + moved + _U(k + 1))
        if k < size - 1:
            firsts = np.cumsum(counts) - counts
            short = firsts[counts == k + 1]
            out.append(chained[short])
            at.append(rows[short])
    whole = np.zeros(n, dtype=bool)
    whole[:max(n - size + 1, 0)] = rows[:max(n - size + 1, 0)] == rows[size - 1:] if n >= size else False
    out.append(chained[whole])
    at.append(rows[whole])
    digests, owner = np.concatenate(out), np.concatenate(at)
    order = np.argsort(owner, kind="stable")
    return digests[order], owner[order]


def row_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct shingle digests of every row."""
    for low, high, data, offsets in blocks(column):
        digests, owner = shingles(data, offsets)
        cuts = np.searchsorted(owner, np.arange(high - low + 1))
        for i in range(high - low):
            yield np.unique(digests[cuts[i]:cuts[i + 1]])


def bitmap_words(n: np.ndarray) -> np.ndarray:
    """64-bit words of a set's bitmap: about BITS bits for every shingle, a power of two."""
    return 2 ** np.maximum(0, np.ceil(np.log2(np.maximum(n, 1) * BITS / 64)).astype(np.int64))


def bitmap(found: np.ndarray) -> bytes:
    """One bit per shingle, chosen by the digest's low bits."""
    width = int(bitmap_words(np.array([len(found)]))[0]) * 64
    bits = np.zeros(width, dtype=np.uint8)
    bits[(found & _U(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def required(a, b):
    """Least overlap of two sets of the given sizes that makes them similar."""
    return -(-TOP * (a + b) // (TOP + BOTTOM))


def prefix_length(n: int) -> int:
    return n - -(-TOP * n // BOTTOM) + 1


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles of at least one in HEAVY_SHARE documents of a chunk, with that count."""
    held, docs, size = [], 0, 0

    def counted():
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        keep = counts >= max(HEAVY_LEAST, docs / HEAVY_SHARE)
        return pa.RecordBatch.from_arrays(
            [pa.array(values[keep].view(np.int64)), pa.array(counts[keep])], names=["key", "docs"])

    for batch in batches:
        for found in row_sets(batch.column("text")):
            held.append(found)
            docs += 1
            size += len(found)
            if size >= CHUNK_SHINGLES:
                yield counted()
                held, docs, size = [], 0, 0
    if held:
        yield counted()


def common_shingles(docs: DataFrame) -> np.ndarray:
    total = docs.agg(F.count(F.lit(1))).scalar()
    rows = (
        docs.select("text").mapInArrow(_common, "key long, docs long")
        .groupBy("key").agg(F.sum("docs").alias("docs"))
        .where(F.col("docs") >= F.greatest(F.lit(HEAVY_LEAST), total / (2 * HEAVY_SHARE))).select("key")
    )
    return np.sort(rows.toPandas()["key"].to_numpy(dtype=np.int64).view(_U))


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n, d1, d2, prefix, bits): size, 128-bit digest, leading shingles and bitmap of every row's set."""
    shared = docs.sparkSession.sparkContext.broadcast(common_shingles(docs))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy = shared.value
        for batch in batches:
            sizes, first, second, prefixes, bits = [], [], [], [], []
            for found in row_sets(batch.column("text")):
                n = len(found)
                sizes.append(n)
                bits.append(bitmap(found))
                first.append(np.add.reduce(mixed(found ^ _U(0x51ED270B)), dtype=_U))
                second.append(np.add.reduce(mixed(found + _U(0x2545F4914F6CDD1D)), dtype=_U))
                if n and len(heavy):
                    spot = np.minimum(np.searchsorted(heavy, found), len(heavy) - 1)
                    late = heavy[spot] == found
                    found = np.concatenate([found[~late], found[late]])
                prefixes.append(found[:prefix_length(n)] if n else found)
            lengths = np.array([len(p) for p in prefixes], dtype=np.int64)
            values = np.concatenate(prefixes) if prefixes else np.zeros(0, dtype=_U)
            bounds = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(sizes, pa.int32()),
                pa.array(np.array(first, dtype=_U).view(np.int64)), pa.array(np.array(second, dtype=_U).view(np.int64)),
                pa.ListArray.from_arrays(bounds, pa.array(values.view(np.int64))), pa.array(bits, pa.binary()),
            ], names=["doc_id", "n", "d1", "d2", "prefix", "bits"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        rows, "doc_id long, n int, d1 long, d2 long, prefix array<long>, bits binary")


def sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of ``nodes`` (node, ...) with items: the sorted digests of the node's text, as bytes."""
    kept = nodes.columns

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = [found.tobytes() for found in row_sets(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(items, pa.binary())], names=[*kept, "items"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(nodes, "node").select(*kept, "text")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema.fields)
    return chosen.mapInArrow(rows, f"{schema}, items binary")


# --- meeting by shingles ------------------------------------------------------------
def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of every run of equal values."""
    edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
    return edges, np.diff(np.concatenate([edges, [len(key)]]))


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of shingles with two nodes or more; input sorted by key."""
    names = ["key", "node", "n", "pos"]
    last, shown = None, False   # the last row and whether it went out
    for batch in batches:
        if not batch.num_rows:
            continue
        key, node, n, pos = (batch.column(c).to_numpy(zero_copy_only=False) for c in names)
        if last is not None:
            key, node, n, pos = (np.concatenate([[c], x]) for c, x in zip(last, (key, node, n, pos)))
        starts, lengths = _runs(key)
        keep = np.repeat(lengths > 1, lengths)
        if last is not None:
            keep[0] = keep[0] and not shown
        last, shown = (key[-1], node[-1], n[-1], pos[-1]), bool(lengths[-1] > 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[keep]) for x in (key, node, n.astype(np.int32), pos.astype(np.int32))], names=names)


def _matrix(bits: list[bytes], words: int) -> np.ndarray:
    """Bitmaps as rows of the same width: wider ones are folded, which the digest's low bits allow."""
    out = np.zeros((len(bits), words), dtype=_U)
    for i, one in enumerate(bits):
        value = np.frombuffer(one, dtype=_U)
        out[i] = np.bitwise_or.reduce(value.reshape(-1, words), axis=0)
    return out


NARROW = ["tile", "node", "n", "comp", "own_band", "home", "housed", "pos", "open"]
NARROW_SCHEMA = "tile long, node long, n int, comp long, own_band boolean, home long, housed boolean, pos int, open long"


class Narrow:
    """Rows of whole tiles, sorted by tile and size, without their bitmaps."""

    def __init__(self, rows: pa.Table):
        columns = [rows.column(c).to_numpy() for c in NARROW]
        self.tile, self.node, self.n, self.comp, self.own, self.home, self.housed, self.pos, self.open = columns
        self.n = self.n.astype(np.int64)
        # places of a set's leading shingles beyond the overlap that its smallest partner needs
        self.prefix = self.n + (TOP * -self.n) // BOTTOM + 1

    def neighbours(self, among: np.ndarray):
        """Pairs of rows (left, right) of one tile in the ratio of sizes, ``among`` ascending, that are open."""
        left, gap = np.arange(len(among)), 0
        while len(left):
            gap += 1
            left = left[left + gap < len(among)]
            a, b = among[left], among[left + gap]
            # sizes ascend within a tile: once a partner is too large, all later ones are
            goes = (self.tile[a] == self.tile[b]) & (BOTTOM * self.n[a] >= TOP * self.n[b])
            left, a, b = left[goes], a[goes], b[goes]
            go = (self.comp[a] != self.comp[b]) & (self.own[a] | self.own[b])
            go &= ~((self.home[a] == self.home[b]) & self.housed[a] & self.housed[b])
            need = required(self.n[a], self.n[b])
            # the first shared shingle leaves room for the overlap in both sets
            go &= (self.n[a] - self.pos[a] >= need) & (self.n[b] - self.pos[b] >= need)
            # shingles that both sets' leading parts must share
            least = np.minimum(self.prefix[a] - self.n[a], self.prefix[b] - self.n[b]) + need
            go &= np.minimum(self.open[a], self.open[b]) >= least
            if go.any():
                yield a[go], b[go]


def _with_partner(rows: pa.Table) -> pa.Table:
    """The rows that have a partner in their tile."""
    narrow = Narrow(rows)
    has = np.zeros(rows.num_rows, dtype=bool)
    for a, b in narrow.neighbours(np.arange(rows.num_rows)):
        has[a] = has[b] = True
    return rows.filter(pa.array(has))


def _tile_pairs(rows: pa.Table) -> list[tuple]:
    """Pairs (a, b, comp_a, comp_b, bound) of whole tiles that may be similar; rows sorted by tile and size.

    Similar sets differ by one bitmap width at most, so each width meets itself and the next.
    """
    narrow, bits = Narrow(rows), rows.column("bits").to_pylist()
    n, node, comp = narrow.n, narrow.node, narrow.comp
    width = bitmap_words(n)
    found = []
    for words in np.unique(width):
        among = np.flatnonzero((width == words) | (width == 2 * words))
        maps = _matrix([bits[i] for i in among], int(words))
        filled = np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
        place = np.zeros(len(n), dtype=np.int64)
        place[among] = np.arange(len(among))
        for a, b in narrow.neighbours(among):
            go = (width[a] == words) | (width[b] == words)
            a, b = a[go], b[go]
            if not len(a):
                continue
            i, j = place[a], place[b]
            shared = np.bitwise_count(maps[i] & maps[j]).sum(axis=1, dtype=np.int64)
            bound = np.minimum(n[a] - (filled[i] - shared), n[b] - (filled[j] - shared))
            ok = bound >= required(n[a], n[b])
            if ok.any():
                a, b, bound = a[ok], b[ok], bound[ok]
                found.append((node[a], node[b], comp[a], comp[b], bound / (n[a] + n[b] - bound)))
    return found


def _whole_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Some tens of thousands of rows at once, tiles whole; input sorted by tile, which may span batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < TILE_UNIT:
            continue
        rows = pa.Table.from_batches(held)
        tile = rows.column("tile").to_numpy()
        cut = int(np.searchsorted(tile, tile[-1]))   # the last tile may go on
        if cut:
            yield rows.slice(0, cut)
        held = rows.slice(cut).combine_chunks().to_batches()
    if held:
        rows = pa.Table.from_batches(held)
        if rows.num_rows:
            yield rows


def _partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _whole_tiles(batches):
        yield from _with_partner(rows).to_batches()


def _tiles(best_only: bool):
    """Function for candidate pairs of tiles (of two components the best); input sorted by tile, which may span batches."""
    names = ["a", "b", "comp_a", "comp_b", "bound"]

    def pairs(rows: pa.Table) -> pa.RecordBatch:
        found = _tile_pairs(rows)
        if not found:
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 4 + [pa.array([], pa.float64())], names=names)
        a, b, ca, cb, bound = (np.concatenate(x) for x in zip(*found))
        swap = ca > cb
        a[swap], b[swap], ca[swap], cb[swap] = b[swap], a[swap], cb[swap], ca[swap]
        if best_only:
            order = np.lexsort((b, a, -bound, cb, ca))
            first = np.concatenate([[True], (ca[order][1:] != ca[order][:-1]) | (cb[order][1:] != cb[order][:-1])])
            once = order[first]
        else:
            _, once = np.unique(np.stack([a, b]), axis=1, return_index=True)
        return pa.RecordBatch.from_arrays([pa.array(x[once]) for x in (a, b, ca, cb, bound)], names=names)

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_tiles(batches):
            yield pairs(rows)

    return tiles


def partners(met: DataFrame, labels: DataFrame, placed: DataFrame) -> DataFrame:
    """Rows of tiles (see NARROW) that have a partner of another component there.

    Tiles come from shingles that two components share; pairs of one home have been compared and
    are left out. In a shingle with many nodes those of its largest component meet the others only.
    """
    known = placed.select("node", "home").join(labels, "node", "full").select(
        "node", "home", F.col("component"))
    labeled = met.join(known, "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component")
    groups = labeled.groupBy("key").agg(
        F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.min("home").alias("h0"), F.max("home").alias("h1"),
        F.count(F.lit(1)).alias("rows"), F.count("home").alias("housed"))
    mixed_homes = (F.col("housed") < F.col("rows")) | (F.col("h0") != F.col("h1"))
    open_keys = groups.where(F.col("c0") != F.col("c1")).where(mixed_homes).select("key", "rows")
    open_rows = staged(labeled.join(open_keys, "key"), "open_rows")
    release(met.sparkSession)
    small = F.col("rows") <= BLOCK_ROWS
    largest = open_rows.where(~small).groupBy("key", "comp").agg(F.count(F.lit(1)).alias("of")).groupBy("key").agg(
        F.max(F.struct("of", "comp")).alias("main"))
    open_rows = open_rows.join(open_rows.groupBy("node").agg(F.count(F.lit(1)).alias("open")), "node").join(
        largest, "key", "left")
    # 4/3 is the largest ratio of sizes, so a band and the one before hold every partner
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(BOTTOM / TOP) + 1e-9).cast("int")
    banded = open_rows.withColumn("band", F.when(small, F.lit(0)).otherwise(band)).withColumn("at", F.explode(
        F.when(small, F.array(F.lit(0))).otherwise(F.array(F.col("band"), F.col("band") + 1))))
    # blocks 0..mains-1 hold the largest component, which is connected; the blocks after them meet all
    mains = F.when(small, 0).otherwise(F.ceil(F.col("main.of") / BLOCK_ROWS)).cast("int")
    others = F.when(small, 1).otherwise(F.ceil((F.col("rows") - F.col("main.of")) / BLOCK_ROWS)).cast("int")
    inside = ~small & (F.col("comp") == F.col("main.comp"))
    place = F.pmod(F.xxhash64("node"), F.when(inside, mains).otherwise(others)).cast("int")
    last = mains + others - 1
    met_blocks = banded.withColumn("own", F.when(inside, place).otherwise(mains + place)).withColumn(
        "other", F.explode(F.sequence(F.when(inside, mains).otherwise(0), last)))
    tile = F.xxhash64("key", "at", F.least("own", "other"), F.greatest("own", "other"))
    rows = met_blocks.select(
        "node", "n", "comp", (F.col("band") == F.col("at")).alias("own_band"), tile.alias("tile"),
        F.coalesce("home", F.lit(0)).alias("home"), F.col("home").isNotNull().alias("housed"), "pos", "open")
    left = staged(
        rows.repartition("tile").sortWithinPartitions("tile", "n", "node").select(*NARROW)
        .mapInArrow(_partners, NARROW_SCHEMA), "partners")
    release(met.sparkSession)
    return left


def candidates(left: DataFrame, bits: DataFrame, best_only: bool) -> DataFrame:
    """Pairs of different components that may be similar (of two components the best), from the rows of ``partners``."""
    return (
        left.join(bits, ["node", "n"])
        .repartition("tile").sortWithinPartitions("tile", "n", "node").select(*NARROW, "bits")
        .mapInArrow(_tiles(best_only), "a long, b long, comp_a long, comp_b long, bound double")
    )


# --- exact comparison ---------------------------------------------------------------
def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist()):
            x, y = np.frombuffer(x, dtype=_U), np.frombuffer(y, dtype=_U)
            shared = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(BOTTOM * shared >= TOP * (len(x) + len(y) - shared))
        kept = batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        yield kept


def links(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar. Sets are made anew for the nodes of the pairs only."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    items = staged(sets(docs, nodes), "items")
    release(docs.sparkSession)
    left = items.select(F.col("node").alias("a"), F.col("items").alias("left"))
    right = items.select(F.col("node").alias("b"), F.col("items").alias("right"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "left", "right")
    found = staged(joined.mapInArrow(_similar, "a long, b long").distinct(), "links")
    release(docs.sparkSession)
    return found


def homes(met: DataFrame) -> DataFrame:
    """(node, home, blocks): the leader that a node meets most often, and the blocks its home is cut into."""
    prefix = F.col("n") - F.ceil(TOP * F.col("n") / BOTTOM) + 1
    shares = met.groupBy("node", "n").agg((F.count(F.lit(1)) / F.first(prefix)).alias("share"))
    ranked = met.join(shares, ["node", "n"])
    leaders = ranked.groupBy("key").agg(F.max(F.struct("share", (-F.col("node")).alias("least"))).alias("top")).select(
        "key", (-F.col("top.least")).alias("home"))
    counted = met.join(leaders, "key").groupBy("node", "home").agg(
        F.count(F.lit(1)).alias("met"), F.first(prefix).alias("prefix"))
    best = counted.where(HOME_SHARE * F.col("met") >= F.col("prefix")).groupBy("node").agg(
        F.max(F.struct("met", (-F.col("home")).alias("least"))).alias("top"))
    placed = staged(best.select("node", (-F.col("top.least")).alias("home")), "homes")
    sizes = placed.groupBy("home").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    return placed.join(sizes, "home").select(
        "node", "home", F.ceil(F.col("rows") / BLOCK_ROWS).cast("int").alias("blocks"))


def _home_links(node: list[int], items: list[bytes], joined: list[bool]) -> list[tuple[int, int]]:
    """Links that connect whatever the pairs of these nodes connect; those that are ``joined`` are connected."""
    order = sorted(range(len(node)), key=lambda i: (len(items[i]), node[i]))
    node, found = [node[i] for i in order], [np.frombuffer(items[i], dtype=_U) for i in order]
    together = np.array([joined[i] for i in order], dtype=bool)
    size = np.array([len(f) for f in found], dtype=np.int64)
    words = 2 * int(bitmap_words(size[len(size) // 2:][:1])[0])
    maps = np.zeros((len(node), words), dtype=_U)
    for i, f in enumerate(found):
        bits = np.zeros(words * 64, dtype=np.uint8)
        bits[(f & _U(words * 64 - 1)).astype(np.int64)] = 1
        maps[i] = np.packbits(bits, bitorder="little").view(_U)
    filled = np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
    label = np.arange(len(node))
    if together.any():
        label[together] = np.flatnonzero(together)[0]
    out = []
    for i in range(len(node) - 1):
        last = int(np.searchsorted(size, BOTTOM * size[i] // TOP, "right"))
        near = np.arange(i + 1, last)
        near = near[label[near] != label[i]]
        if not len(near):
            continue
        need = required(size[i], size[near])
        shared = np.bitwise_count(maps[i] & maps[near]).sum(axis=1, dtype=np.int64)
        bound = np.minimum(size[i] - (filled[i] - shared), size[near] - (filled[near] - shared))
        likely = np.flatnonzero(bound >= need)
        for k in likely[np.argsort(-(bound[likely] - need[likely]), kind="stable")].tolist():
            j = int(near[k])
            if label[j] != label[i] and len(np.intersect1d(found[i], found[j], assume_unique=True)) >= need[k]:
                out.append((node[i], node[j]))
                label[label == label[j]] = label[i]
    return out


def _home_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of whole homes; input sorted by tile, which may span batches."""
    now, node, items, joined = None, [], [], []

    def made(links: list[tuple[int, int]]) -> pa.RecordBatch:
        a, b = zip(*links) if links else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    for batch in batches:
        links: list[tuple[int, int]] = []
        for tile, one, item, held in zip(*(batch.column(c).to_pylist() for c in ("tile", "node", "items", "joined"))):
            if tile != now:
                if len(node) > 1:
                    links += _home_links(node, items, joined)
                now, node, items, joined = tile, [], [], []
            node.append(one)
            items.append(item)
            joined.append(held)
        yield made(links)
    if len(node) > 1:
        yield made(_home_links(node, items, joined))


def _home_tiles(docs: DataFrame, tiles: DataFrame) -> DataFrame:
    """Links found in tiles (node, tile, joined); a node's set is made once and goes to each of its tiles."""
    wanted = tiles.groupBy("node", "joined").agg(F.collect_list("tile").alias("tiles"))
    rows = sets(docs, wanted).select("node", "joined", "items", F.explode("tiles").alias("tile"))
    found = staged(rows.repartition("tile").sortWithinPartitions("tile").select("tile", "node", "items", "joined")
                   .mapInArrow(_home_rows, "a long, b long").distinct(), "home_links")
    release(docs.sparkSession)
    return found


def home_links(docs: DataFrame, placed: DataFrame) -> DataFrame:
    """Links inside homes, enough of them to connect what all such links connect.

    A home of one block is one tile. In a larger one every member meets the leader, which moves each set
    once; a pair of members that both have that link is connected. The others, in blocks of their own, meet all blocks.
    """
    small = placed.where("blocks = 1").select("node", F.xxhash64("home").alias("tile"), F.lit(False).alias("joined"))
    found = _home_tiles(docs, small)
    large = staged(placed.where("blocks > 1"), "large_homes")
    if large.isEmpty():
        return found
    leaders = staged(sets(docs, large.select(F.col("home").alias("node")).distinct()), "leaders")
    members = sets(docs, large.where("node != home")).select("node", "home", F.col("items").alias("left"))
    both = members.join(leaders.select(F.col("node").alias("home"), F.col("items").alias("right")), "home")
    led = staged(both.select(F.col("node").alias("a"), F.col("home").alias("b"), "left", "right")
                 .mapInArrow(_similar, "a long, b long"), "led")
    release(docs.sparkSession)
    with_link = led.select(F.col("a").alias("node"), F.lit(True).alias("__led"))
    # the leader itself may have another home; in its own it is connected
    marked = large.join(with_link, "node", "left").withColumn(
        "joined", F.coalesce("__led", F.lit(False)) | (F.col("node") == F.col("home"))).drop("__led")
    marked = staged(marked, "led_homes")
    loose = marked.where("NOT joined").groupBy("home").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("loose"))
    # blocks 0..blocks-1 hold connected members, blocks after them the others
    number = F.pmod(F.xxhash64("node"), F.when(F.col("joined"), F.col("blocks")).otherwise(F.col("loose"))).cast("int")
    block = F.when(F.col("joined"), number).otherwise(F.col("blocks") + number)
    every = F.col("blocks") + F.col("loose") - 1
    others = F.when(F.col("joined"), F.sequence(F.col("blocks"), every)).otherwise(F.sequence(F.lit(0), every))
    tiles = marked.join(loose, "home").withColumn("own", block).withColumn("other", F.explode(others)).select(
        "node", F.xxhash64("home", F.least("own", "other"), F.greatest("own", "other")).alias("tile"), "joined")
    return found.union(led).union(_home_tiles(docs, tiles))


def similar_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of (doc_id, text)."""
    spark = docs.sparkSession
    signed = staged(signatures(docs), "sets")
    classes = signed.where("n > 0").groupBy("n", "d1", "d2").agg(
        F.min("doc_id").alias("node"), F.first("prefix").alias("prefix"))
    keyed = classes.where("node IS NOT NULL").select("node", "n", F.posexplode("prefix").alias("pos", "key"))
    met = staged(
        keyed.select("key", "node", "n", "pos").repartition("key").sortWithinPartitions("key")
        .mapInArrow(_meetings, "key long, node long, n int, pos int"), "met")
    release(spark)
    placed = staged(homes(met), "placed")
    release(spark)
    edges = home_links(docs, placed)
    found = staged(components(edges), "components")
    bits = signed.where("n > 0").select(F.col("doc_id").alias("node"), "n", "bits").distinct()
    left = partners(met, found, placed)
    for best_only in (True, False):
        pairs = candidates(left, bits, best_only)
        if best_only:
            pairs = pairs.groupBy("comp_a", "comp_b").agg(F.max(F.struct("bound", "a", "b")).alias("p")).select("p.a", "p.b")
        else:
            pairs = pairs.select("a", "b").distinct()
        pairs = staged(pairs, "pairs")
        release(spark)
        if pairs.isEmpty():
            break
        edges = edges.union(links(docs, pairs))
        found = staged(components(edges), "components")
        # components have only grown: rows without a partner have none now either
        left = left.drop("comp").join(found, "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component")
        release(spark)
    nodes = signed.where("n > 0").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("node"))
    named = nodes.join(found, "node", "left").select(
        "n", "d1", "d2", F.coalesce("component", "node").alias("component_id"))
    return signed.select("doc_id", "n", "d1", "d2").join(named, ["n", "d1", "d2"], "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))

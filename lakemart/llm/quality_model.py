"""Quality classifier: random-indexing word vectors, pooled per document, into a small calibrated network.

1. Every token (a run of letters, digits or symbols) gets a sparse random index vector from its 64-bit digest. A token's
   context vector is the sum of the index vectors of its neighbours in all texts, so it is
   gathered over the whole corpus. TABLES tables of ROWS rows bound it whatever the
   vocabulary: a token's context is added to one row of each, under a sign of its own, and
   read back as the median of its rows under these signs. What other tokens put into a row
   has random signs, so it cancels in the mean, and the median leaves out a row that a
   frequent token holds. Counts are the least of the rows. Each task adds up its own
   tables, which are summed by row.
2. A document is the mean of its tokens' context vectors (rare ones weigh more), the
   mean of their own index vectors, and a few shares (symbols, capitals, repeats, length).
3. A two-layer network in numpy learns from labelled rows outside the held-out fold; a
   slice of them sets a temperature that makes its probabilities honest.

Only text enters a score. The sample of labelled rows is drawn by digest and bounded by
SAMPLE_ROWS; context vectors, counts and scores cover every row.

Defined results: a null or empty text has zero vectors and is scored like any other; a
label of null is left out; repeated labels of a row count as repeated; without labels of
both kinds every score is the share of good labels, or 0.5 without any.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import staged
from lakemart.llm.kernels import LOWER, SPACES, Digests, blocks, mixed, stream

TABLES = 3                # the median below is that of three
ROWS = 1 << 14
WIDTH = 48
REACH = 2                 # neighbours on either side
NONZERO = 2               # entries of an index vector
SAMPLE_ROWS = 20_000      # bound of the labelled sample
FOLDS = 5                 # rows whose digest is 0 modulo this are held out
HIDDEN = 32
EPOCHS = 60
CALIBRATION = 5           # one labelled row in so many sets the temperature
THRESHOLD = 0.3
SHARES = 7
FLUSH = 1 << 27           # tokens after which a task sends its tables on, so that their sums stay 32-bit numbers
WAVES = 4                 # partial tables for every core of the cluster
_U = np.uint64

# kinds of bytes: white space, letters (and all of other alphabets), digits, symbols
SPACE_KIND, LETTER, DIGIT, SYMBOL = range(4)
KIND = np.full(256, SYMBOL, dtype=np.uint8)
KIND[128:] = LETTER
KIND[np.arange(65, 91)] = KIND[np.arange(97, 123)] = LETTER
KIND[48:58] = DIGIT
KIND[SPACES] = SPACE_KIND


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(digest, text row) of every token of a block: a run of letters, of digits or of symbols, in lower case."""
    n = len(data)
    if not n:
        return np.zeros(0, dtype=_U), np.zeros(0, dtype=np.int64)
    kind = KIND[data]
    edge = np.ones(n + 1, dtype=bool)
    edge[1:n] = kind[1:] != kind[:-1]
    edge[offsets] = True
    bounds = np.flatnonzero(edge)
    starts, ends = bounds[:-1], bounds[1:]
    solid = kind[starts] != SPACE_KIND
    starts, ends = starts[solid], ends[solid]
    digests = Digests(LOWER[data]).of(starts, ends)
    return digests, np.searchsorted(offsets, starts, "right") - 1


def index_entries(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of every token's index vector."""
    draws = mixed(digests[:, None] + stream(NONZERO, 53))
    return (draws % _U(WIDTH)).astype(np.int64), np.where(draws >> _U(63), 1, -1)


def table_rows(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and sign of every token in each table; the tables lie one after the other."""
    draws = mixed(digests[:, None] + stream(TABLES, 59))
    return (draws % _U(ROWS)).astype(np.int64) + np.arange(TABLES) * ROWS, np.where(draws >> _U(63), 1, -1)


def scaled(x: np.ndarray) -> np.ndarray:
    """Sums on a logarithmic scale with their signs; the median of three is the same before and after."""
    return np.sign(x) * np.log1p(np.abs(x))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per table row that occurs in this task: its count and summed signed context."""
    sums, counts, seen = np.zeros((TABLES * ROWS, WIDTH)), np.zeros(TABLES * ROWS, dtype=np.int64), 0

    def add(ids: np.ndarray, owner: np.ndarray) -> None:
        nonlocal counts
        rows, turns = table_rows(ids)
        places, signs = index_entries(ids)
        near = [(np.flatnonzero(owner[:-gap] == owner[gap:]), gap) for gap in range(1, REACH + 1)]
        here = np.concatenate([side for low, gap in near for side in (low, low + gap)])
        there = np.concatenate([side for low, gap in near for side in (low + gap, low)])
        columns, weights = places[there], signs[there]
        for t in range(TABLES):
            own = slice(t * ROWS, (t + 1) * ROWS)
            cells = (rows[here, t, None] - t * ROWS) * WIDTH + columns
            sums[own] += np.bincount(cells.ravel(), weights=(weights * turns[here, t, None]).ravel(),
                                     minlength=ROWS * WIDTH).reshape(ROWS, WIDTH)
        counts += np.bincount(rows.ravel(), minlength=TABLES * ROWS)

    def sent() -> pa.RecordBatch:
        used = np.flatnonzero(counts)
        cells = pa.array(sums[used].ravel().astype(np.int32))
        return pa.RecordBatch.from_arrays([
            pa.array(used), pa.array(counts[used]),
            pa.ListArray.from_arrays(np.arange(0, (len(used) + 1) * WIDTH, WIDTH, dtype=np.int32), cells),
        ], names=["bucket", "count", "context"])

    for batch in batches:
        for _, _, data, offsets in blocks(batch.column("text")):
            ids, owner = tokens(data, offsets)
            if not len(ids):
                continue
            if seen and seen + len(ids) > FLUSH:
                yield sent()
                sums[:], counts[:], seen = 0, 0, 0
            add(ids, owner)
            seen += len(ids)
    yield sent()


def word_tables(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """Summed signed contexts, scaled, and counts by table row, from all texts, and the number of tokens."""
    texts = docs.select("text").coalesce(WAVES * docs.sparkSession.sparkContext.defaultParallelism)
    parts = texts.mapInArrow(_contexts, "bucket long, count long, context array<int>")
    summed = parts.groupBy("bucket").agg(
        F.sum("count").alias("count"), *[F.sum(F.get("context", F.lit(i))).alias(f"c{i}") for i in range(WIDTH)])
    rows = summed.toPandas()
    contexts, counts = np.zeros((TABLES * ROWS, WIDTH), dtype=np.float32), np.zeros(TABLES * ROWS)
    at = rows["bucket"].to_numpy(dtype=np.int64)
    contexts[at] = scaled(rows[[f"c{i}" for i in range(WIDTH)]].to_numpy(dtype=np.float64))
    counts[at] = rows["count"].to_numpy(dtype=np.float64)
    return contexts, counts, max(counts[:ROWS].sum(), 1.0)


def word_vectors(digests: np.ndarray, contexts: np.ndarray, counts: np.ndarray, total: float) -> tuple[np.ndarray, np.ndarray]:
    """Unit context vector and weight of every token: rare ones weigh more."""
    rows, signs = table_rows(digests)
    a, b, c = (contexts[rows[:, t]] for t in range(TABLES))
    for own, sign in zip((a, b, c), signs.T.astype(np.float32)):
        own *= sign[:, None]
    vectors = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b, out=a), c, out=c), out=b)
    norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    vectors /= np.maximum(norms, 1e-9)[:, None]
    return vectors, (1 / (1 + 1000 * counts[rows].min(axis=1) / total)).astype(np.float32)


def features(data: np.ndarray, offsets: np.ndarray, *tables) -> np.ndarray:
    """Pooled vectors and shares of the texts of a block: one row each."""
    rows = len(offsets) - 1
    out = np.zeros((rows, 2 * WIDTH + SHARES), dtype=np.float32)
    digests, owner = tokens(data, offsets)
    if not len(digests):
        return out
    names, ids = np.unique(digests, return_inverse=True)
    cuts = np.searchsorted(owner, np.arange(rows + 1))
    many = np.diff(cuts)
    full = np.flatnonzero(many)
    vectors, weights = word_vectors(names, *tables)
    weight = weights[ids]
    vectors *= weights[:, None]
    sums = np.add.reduceat(vectors[ids], cuts[full], axis=0)
    out[full, :WIDTH] = sums / np.add.reduceat(weight, cuts[full])[:, None]
    places, signs = index_entries(names)
    own = np.zeros(rows * WIDTH)
    for k in range(NONZERO):
        own += np.bincount(owner * WIDTH + places[ids, k], weights=signs[ids, k], minlength=rows * WIDTH)
    out[full, WIDTH:2 * WIDTH] = own.reshape(rows, WIDTH)[full] / many[full, None]
    lengths = np.diff(offsets)

    def counted(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return (sums[offsets[1:]] - sums[offsets[:-1]])[full]

    kind, n = KIND[data], lengths[full]
    letters, capitals, symbols = counted(kind == LETTER), counted((data > 64) & (data < 91)), counted(kind >= DIGIT)
    distinct = np.array([len(np.unique(ids[cuts[i]:cuts[i + 1]])) for i in full])
    lines = [data[offsets[i]:offsets[i + 1]].tobytes().split(b"\n") for i in full]
    out[full, 2 * WIDTH:] = np.stack([
        np.log1p(many[full]) / 10, distinct / many[full], capitals / n, letters / n,
        symbols / n, [len(set(x)) / len(x) for x in lines], letters / many[full] / 10], axis=1)
    return out


class Network:
    """Features to the logit of a good label: one hidden layer, trained by full passes of Adam over batches."""

    def __init__(self, width: int, seed: int = 1):
        draw = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(width), np.ones(width)
        self.parts = [draw.normal(0, width ** -0.5, (width, HIDDEN)), np.zeros(HIDDEN),
                      draw.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
        self.temperature = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        w, b, v, c = self.parts
        return np.maximum((x - self.mean) / self.scale @ w + b, 0) @ v + c[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))

    def fit(self, x: np.ndarray, y: np.ndarray, seed: int = 2, rate: float = 3e-3, decay: float = 1e-4) -> None:
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        z = (x - self.mean) / self.scale
        draw = np.random.default_rng(seed)
        first, second, step = [np.zeros_like(p) for p in self.parts], [np.zeros_like(p) for p in self.parts], 0
        for _ in range(EPOCHS):
            order = draw.permutation(len(z))
            for low in range(0, len(z), 128):
                rows = order[low:low + 128]
                w, b, v, c = self.parts
                hidden = np.maximum(z[rows] @ w + b, 0)
                error = (1 / (1 + np.exp(-np.clip(hidden @ v + c[0], -30, 30))) - y[rows]) / len(rows)
                back = np.outer(error, v) * (hidden > 0)
                step += 1
                for k, slope in enumerate((z[rows].T @ back + decay * w, back.sum(axis=0),
                                           hidden.T @ error + decay * v, np.array([error.sum()]))):
                    first[k] = 0.9 * first[k] + 0.1 * slope
                    second[k] = 0.999 * second[k] + 0.001 * slope ** 2
                    self.parts[k] = self.parts[k] - rate * (first[k] / (1 - 0.9 ** step)) / (
                        np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """The temperature with the least log loss."""
        raw = self.logits(x)
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 120))
        losses = [np.mean(np.logaddexp(0, raw / t) - y * raw / t) for t in grid]
        self.temperature = float(grid[int(np.argmin(losses))])


def train(x: np.ndarray, y: np.ndarray) -> Network | float:
    """A calibrated network, or one score for all where the labels are of one kind."""
    if len(np.unique(y)) < 2:
        return float(y.mean()) if len(y) else 0.5
    held = np.arange(len(y)) % CALIBRATION == 0
    if len(np.unique(y[~held])) < 2 or len(np.unique(y[held])) < 2:
        held[:] = False
    model = Network(x.shape[1])
    model.fit(x[~held], y[~held])
    model.calibrate(x[held], y[held]) if held.any() else None
    return model


def score(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of (doc_id, text), from labels (doc_id, quality)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(word_tables(docs))

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [features(data, offsets, *shared.value).ravel() for _, _, data, offsets in blocks(batch.column("text"))]
            values = np.concatenate(parts) if parts else np.zeros(0, dtype=np.float32)
            bounds = np.arange(batch.num_rows + 1, dtype=np.int32) * (2 * WIDTH + SHARES)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(bounds, pa.array(values, pa.float32()))],
                names=["doc_id", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    pool = staged(docs.select("doc_id", "text").mapInArrow(pooled, f"doc_id {kind}, x array<float>"), "pooled")
    usable = labels.where(F.col("quality").isNotNull() & (remainder(F.col("doc_id")) != 0)).select(
        "doc_id", F.col("quality").cast("int").alias("y"))
    known = pool.join(usable, "doc_id")
    total = known.count()
    draw = (F.xxhash64("doc_id", F.lit(3)) % (1 << 31) + (1 << 31)) / float(1 << 32)
    drawn = known.where(draw < min(1.0, sample_rows / max(total, 1))).toPandas()
    drawn["at"] = [int(mixed(np.array([i], dtype=np.int64).view(_U))[0]) for i in drawn["doc_id"]]
    drawn = drawn.sort_values(["at", "y"])
    x = np.stack(drawn["x"].to_list()).astype(np.float64) if len(drawn) else np.zeros((0, 2 * WIDTH + SHARES))
    model = spark.sparkContext.broadcast(train(x, drawn["y"].to_numpy(dtype=np.float64)))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1) if batch.num_rows else None
            known = model.value
            if values is None:
                out = np.zeros(0)
            elif isinstance(known, float):
                out = np.full(batch.num_rows, known)
            else:
                out = known.scores(values.astype(np.float64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out)], names=["doc_id", "score"])

    result = pool.mapInArrow(scored, f"doc_id {kind}, score double")
    return result.select(
        "doc_id", F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

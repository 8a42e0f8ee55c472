"""Mix sources to target weights.

Every row gets a hash-random key. Rows are range-sorted by that key inside their
source, a prefix sum of sizes runs over the ranges, and the sorted sequence is cut
at the source's budget: to the word in ``plan``, at the nearest whole row in ``mix``. A budget above the source's size repeats whole epochs.

The key is a digest, so its leading digits cut the key space into equal ranges
without sampling: a source with a third of all rows is spread over all of them.
Only one row per source and range is summed up across ranges.

Defined results: a null text has size 0; a null source is a source of its own, after
all others; equal keys (repeated ids) are ordered by text; an empty table gives an
empty plan; a table without words takes nothing. Other columns are ignored here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import staged, word_count

MAX_EPOCHS = 3       # no row is taken more often
WEIGHTS = (1, 2, 3)  # by rank of the source, repeating
RANGE_DIGITS = 3     # leading hex digits of the key: 4096 ranges a source
SEED = "mix"


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Budget of each source from rows (source, source_size).

    Sources share the sum of all sizes by weight. A share above ``max_epochs`` times
    the source's size stops there and the rest is shared anew among the others. The
    level at which this ends is the largest of the levels got by capping the sources
    one by one in order of cap over weight.
    """
    ranked = sizes.withColumn("__rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    pattern = F.array(*[F.lit(w) for w in weights])
    weighted = ranked.withColumn("weight", F.get(pattern, (F.col("__rank") - 1) % len(weights))).withColumn(
        "cap", max_epochs * F.col("source_size")
    )
    order = Window.orderBy(F.col("cap") / F.col("weight"), "__rank")
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(ahead), F.lit(0))
    ).cast("double") / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(ahead), F.lit(0)))
    leveled = weighted.withColumn("__level", level)
    return leveled.withColumn("__top", F.max("__level").over(every)).select(
        "source", "source_size",
        F.least(F.col("cap").cast("double"), F.col("__top") * F.col("weight")).alias("target"),
    )


def plan(docs: DataFrame, weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED,
         carry: tuple[str, ...] = ()) -> DataFrame:
    """How often each row of (doc_id, text, source) is taken: one row per input row, with the columns ``carry`` of it."""
    sized = staged(
        docs.select(
            "doc_id", "source",
            word_count(F.col("text")).alias("size"),
            F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"))).alias("key"),
            F.xxhash64("text").alias("tie"),
            *carry,
        ).withColumn("range", F.substring("key", 1, RANGE_DIGITS)),
        "mix_sizes",
    )
    ranges = sized.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    budget = targets(ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, max_epochs)
    ahead = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranges.withColumn("offset", F.coalesce(F.sum("range_size").over(ahead), F.lit(0)))
        .alias("r")
        .join(budget.alias("b"), F.col("r.source").eqNullSafe(F.col("b.source")))
        .select("r.source", "r.range", "offset", "source_size", "target")
    )
    placed = sized.alias("d").join(
        offsets.alias("o"),
        F.col("d.source").eqNullSafe(F.col("o.source")) & (F.col("d.range") == F.col("o.range")),
    ).select("d.doc_id", "d.source", "d.size", "d.key", "d.tie", "d.range", "offset", "source_size", "target",
             *[f"d.{c}" for c in carry])
    local = Window.partitionBy("source", "range").orderBy("key", "doc_id", "tie").rowsBetween(
        Window.unboundedPreceding, 0)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    cut = placed.withColumn("before", F.col("offset") + F.sum("size").over(local) - F.col("size")).withColumn(
        "copies", F.least(epochs, F.lit(max_epochs)).cast("long"))
    # what the last, incomplete epoch still takes of this row: all, a part of the row at the cut, or nothing
    rest = F.round("target").cast("long") - F.col("copies") * F.col("source_size")
    part = F.when(F.col("copies") < max_epochs, F.greatest(F.least(rest - F.col("before"), F.col("size")), F.lit(0)))
    return cut.withColumn("part", F.coalesce(part, F.lit(0)).cast("long")).select(
        "doc_id", "source", "key", "tie", "size", "source_size", "target",
        (F.col("size") * F.col("copies") + F.col("part")).alias("taken"), "copies", "part", *carry,
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed rows: every row of ``docs`` as often as the plan takes it, whole and unchanged.

    The row at a source's cut is taken whole or left, whichever is nearer to the target; ``plan`` has the
    count to the word. Each of several equal rows follows its own place in the plan. A row without words
    takes nothing from any budget and comes once.
    """
    held = staged(docs.select(F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("row")), "mix_rows")
    rows = held.select("doc.doc_id", "doc.source", "doc.text", "row")
    counts = plan(rows, carry=("row",), **options)
    nearest = F.when((F.col("part") > 0) & (2 * F.col("part") >= F.col("size")), 1).otherwise(0)
    times = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.col("copies") + nearest).cast("int")
    taken = counts.select("row", times.alias("times")).where("times > 0")
    return held.join(taken, "row").select("doc", F.explode(F.sequence(F.lit(1), "times"))).select("doc.*")

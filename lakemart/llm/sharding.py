"""Sharding by sampled splitters.

Rows are ordered by (digest of the text, id), so equal texts lie side by side. A
sample in which a row's chance grows with its size gives splitters: boundaries
between ranges of about equal bytes. Rows are range-partitioned by the splitters,
each range is measured exactly, and a range above one piece's allowance is
subdivided at its running sizes. Pieces, largest first, go to the lightest shard.

The law is ``bytes``: the shards' sizes differ by no more than a small piece. Equal
texts stay in one shard unless their group exceeds ``WHOLE_PIECES`` pieces (a quarter
of a shard); such a group is cut at its rows.

The sample size is a parameter and bounds what the splitters cost; a row's place
depends on exact sizes, so the sample decides balance of work, not the result's law.

Defined results: a null text counts its fixed part only and digests like an empty
one's null; rows with equal id and text are ordered by all their columns' digest; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import staged

RECORD_BYTES = 8          # fixed part of every record
PIECES_PER_SHARD = 32
WHOLE_PIECES = 8          # a group of equal texts up to so many pieces stays whole
SAMPLES_PER_PIECE = 16


def measured(docs: DataFrame) -> DataFrame:
    """Narrow rows: id, size, checksum and the order key of every record."""
    return docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + RECORD_BYTES).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64("text", F.lit(1)).alias("group_key"),
        F.xxhash64("doc_id", "text").alias("row_key"),
    )


def splitters(rows: DataFrame, ranges: int, samples: int) -> DataFrame:
    """One row: the sorted array of boundaries (group_key, row_key).

    A row is drawn when its own digest, as a number in [0, 1), lies below
    ``samples * size / total``. A boundary moves to the start of its group unless the
    group already holds ``WHOLE_PIECES`` boundaries before it.
    """
    total = rows.agg(F.sum("size").alias("t")).scalar()
    draw = (F.xxhash64("row_key", F.lit(7)) % (1 << 31) + (1 << 31)) / float(1 << 32)
    drawn = rows.where(draw < samples * F.col("size") / total).agg(
        F.sort_array(F.collect_list(F.struct("group_key", "row_key"))).alias("drawn"))
    least = F.lit(-(1 << 63)).cast("long")
    picked = drawn.select(
        "drawn",
        F.transform(
            F.sequence(F.lit(1), F.lit(ranges - 1)),
            lambda i: F.get("drawn", F.floor(i * F.size("drawn") / ranges).cast("int")),
        ).alias("picked"),
    )
    snapped = F.transform(
        "picked",
        lambda x, i: F.struct(
            x["group_key"].alias("group_key"),
            F.when(F.get("picked", i - WHOLE_PIECES)["group_key"] == x["group_key"], x["row_key"])
            .otherwise(least).alias("row_key"),
        ),
    )
    return picked.select(F.array_distinct(F.filter(snapped, lambda x: x["group_key"].isNotNull())).alias("bounds"))


def range_of(group: Column, row: Column, bounds: Column, blocks: Column, width: int) -> Column:
    """Number of boundaries at or below the key: first among blocks of boundaries, then inside the block."""
    key = F.struct(group.alias("group_key"), row.alias("row_key"))
    block = F.size(F.filter(blocks, lambda b: b <= key))
    start = F.greatest(block - 1, F.lit(0)) * width
    inside = F.size(F.filter(F.slice(bounds, start + 1, F.lit(width)), lambda b: b <= key))
    return start + inside


def pieces(rows: DataFrame, shards: int, per_shard: int, per_piece: int) -> DataFrame:
    """Rows with their range, piece inside the range and running position."""
    ranges = shards * per_shard
    width = 28
    bounds = splitters(rows, ranges, ranges * per_piece)
    tops = F.filter("bounds", lambda _, i: i % width == 0)
    both = staged(bounds.select("bounds", tops.alias("tops")), "shard_bounds")
    ranged = rows.withColumns({"__b": both.select("bounds").scalar(), "__t": both.select("tops").scalar()}).withColumn(
        "range", range_of(F.col("group_key"), F.col("row_key"), F.col("__b"), F.col("__t"), width)
    ).drop("__b", "__t")
    order = Window.partitionBy("range").orderBy("group_key")
    through = order.rangeBetween(Window.unboundedPreceding, 0)
    group = Window.partitionBy("range", "group_key")
    running = group.orderBy("row_key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    allowance = F.ceil(rows.agg(F.sum("size").alias("t")).scalar() / ranges)
    placed = ranged.withColumns({
        "__end": F.sum("size").over(through),
        "__group": F.sum("size").over(group),
        "__inside": F.coalesce(F.sum("size").over(running), F.lit(0)),
    })
    start = F.col("__end") - F.col("__group")
    # a large group is cut at its rows, any other goes whole to the piece of its start
    at = F.when(F.col("__group") > WHOLE_PIECES * allowance, start + F.col("__inside")).otherwise(start)
    return placed.withColumn("piece", F.floor(at / allowance)).drop("__end", "__group", "__inside")


def deal(parts: DataFrame, shards: int) -> DataFrame:
    """Shard of every piece: largest first, each to the shard that is lightest so far.

    There are at most twice as many pieces as ranges plus groups cut, a number that the
    shard count fixes, so one row holds them all.
    """
    listed = parts.agg(
        F.sort_array(F.collect_list(F.struct("bytes", "range", "piece", "rows")), asc=False).alias("parts"))
    state = F.struct(
        F.array_repeat(F.lit(0).cast("long"), shards).alias("load"),
        F.array().cast("array<int>").alias("dealt"),
    )

    def step(acc, part):
        best = F.array_position(acc["load"], F.array_min(acc["load"])).cast("int")
        load = F.transform(acc["load"], lambda x, i: F.when(i == best - 1, x + part["bytes"]).otherwise(x))
        return F.struct(load.alias("load"), F.concat(acc["dealt"], F.array(best - 1)).alias("dealt"))

    dealt = F.aggregate("parts", state, step, lambda acc: acc["dealt"])
    return listed.select(F.explode(F.arrays_zip(F.col("parts").alias("part"), dealt.alias("shard"))).alias("x")).select(
        F.col("x.part.range").alias("range"), F.col("x.part.piece").alias("piece"),
        F.col("x.part.rows").alias("rows"), F.col("x.shard").alias("shard"),
    )


def shard(docs: DataFrame, shards: int, per_shard: int = PIECES_PER_SHARD,
          per_piece: int = SAMPLES_PER_PIECE) -> DataFrame:
    """One row per record: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    rows = staged(measured(docs), "shard_rows")
    cut = staged(pieces(rows, shards, per_shard, per_piece), "shard_pieces")
    parts = cut.groupBy("range", "piece").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("shard").orderBy("range", "piece").rowsBetween(Window.unboundedPreceding, -1)
    homes = deal(parts, shards).withColumn("first", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    homes = staged(homes, "shard_homes")
    local = Window.partitionBy("range", "piece").orderBy("group_key", "row_key", "doc_id")
    return cut.join(homes.drop("rows"), ["range", "piece"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("first") + F.row_number().over(local) - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

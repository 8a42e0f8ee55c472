"""Exact distinct counts beside other aggregates in one pass, without copying rows.

Several distinct counts in one aggregate make Spark copy each row once per column. The
star's keys are dense, so a set of keys is a bitmap: a column with keys up to ``top`` takes
one bitmap of 32,768 bits per started 32,768 keys, all filled by the same aggregate as the
sums and combined on the map side.

Bitmaps cost 4 KB each per group and task. Columns are taken into the pass, smallest first,
while the bitmaps of all expected groups stay below ``MOST_BYTES``; any other column is folded
on its own, on the narrow pair of group and value, and meets the rest on the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS_PER_BITMAP = 32_768
BITMAP_BYTES = 4_096
MOST_BYTES = 64 << 20        # of bitmaps that one task may send
MOST_BITMAPS = 96            # aggregates beside each other in one pass
MONTHS = 1_200               # groups expected of a calendar: a hundred years of months


def _bitmaps(column: str, top: int) -> dict[str, Column]:
    """Bitmaps of the keys 0..top of a column: bit and bitmap follow from key + 1, whose first bitmap is 1."""
    key = F.col(column) + 1
    return {
        f"__bits_{column}_{b}": F.bitmap_construct_agg(
            F.when(F.bitmap_bucket_number(key) == b + 1, F.bitmap_bit_position(key)))
        for b in range(top // KEYS_PER_BITMAP + 1)
    }


def _fitting(columns: set[str], tops: dict[str, int], groups: int) -> list[str]:
    """Columns whose bitmaps fit together, those with the fewest keys first."""
    most = min(MOST_BITMAPS, MOST_BYTES // BITMAP_BYTES // max(1, groups))
    taken, used = [], 0
    for column in sorted((c for c in columns if c in tops), key=lambda c: (tops[c], c)):
        used += tops[column] // KEYS_PER_BITMAP + 1
        if used > most:
            break
        taken.append(column)
    return taken


def _folded(rows: DataFrame, by: list[str], out: DataFrame, column: str, name: str) -> DataFrame:
    """``out`` with the number of distinct values of one column, from a pass of its own."""
    values = rows.where(F.col(column).isNotNull()).select(*by, column).distinct()
    if not by:
        return out.withColumn(name, values.agg(F.count(F.lit(1))).scalar())
    counts = values.groupBy(*[F.col(b).alias(f"__{b}") for b in by]).agg(F.count(F.lit(1)).alias(name))
    same = F.lit(True)
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"__{b}"))
    return out.join(counts, same, "left").drop(*[f"__{b}" for b in by]).withColumn(
        name, F.coalesce(name, F.lit(0).cast("long")))


def aggregate(rows: DataFrame, by: list[str], aggregates: list[Column], distinct: dict[str, str],
              approximate: bool = False, tops: dict[str, int] | None = None, groups: int = 1) -> DataFrame:
    """Aggregates per group plus, for each ``{name: column}``, the number of distinct values.

    ``tops`` holds the largest key of the columns that are dense keys from 0 on; ``groups`` is how many
    groups to expect. ``approximate`` counts by sketch in the same pass instead.
    """
    if approximate:
        sketches = [F.approx_count_distinct(c).alias(name) for name, c in distinct.items()]
        return rows.groupBy(*by).agg(*aggregates, *sketches)
    bits = {c: _bitmaps(c, tops[c]) for c in _fitting(set(distinct.values()), tops or {}, groups)}
    built = [expression.alias(name) for held in bits.values() for name, expression in held.items()]
    out = rows.groupBy(*by).agg(*aggregates, *built)
    for name, column in distinct.items():
        if column in bits:
            parts = [F.bitmap_count(b) for b in bits[column]]
            out = out.withColumn(name, sum(parts[1:], parts[0]))
    out = out.drop(*[name for held in bits.values() for name in held])
    for name, column in distinct.items():
        if column not in bits:
            out = _folded(rows, by, out, column, name)
    return out

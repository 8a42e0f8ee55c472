"""Column helpers shared by the operators. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(col: Column, precision: int = 18) -> Column:
    return col.cast(f"decimal({precision},2)")


def dbl(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("double")


def mean_of(col: str) -> Column:
    """Mean from the exact sum, so that it does not depend on row order."""
    return F.sum(col).cast("double") / F.count(col)


def ratio(top: Column, bottom: Column) -> Column:
    """Double division; null when the divisor is zero or null."""
    return F.when(bottom != 0, top.cast("double") / bottom.cast("double"))


def sample_std(col: str) -> Column:
    """Sample standard deviation; null below two rows."""
    return F.stddev_samp(F.col(col).cast("double"))


def clean_text(col: Column) -> Column:
    """Trimmed text; blank and the text 'nan' become null."""
    text = F.trim(col.cast("string"))
    return F.when(~F.lower(text).isin("", "nan"), text)


def in_range(col: Column, low: float, high: float) -> Column:
    """True when the value reads as a number inside [low, high] and above zero."""
    number = F.expr(f"try_cast({_name(col)} AS DOUBLE)") if isinstance(col, str) else col.try_cast("double")
    ok = ~F.isnan(number) & number.between(F.lit(low), F.lit(high)) & (number > 0)
    return F.coalesce(ok, F.lit(False))


def _name(col: str) -> str:
    return f"`{col}`"


def right_closed_bin(col: Column, edges: list, labels: list[str]) -> Column:
    """Label of the interval (lo, hi] that holds the value, else null."""
    label = None
    for low, high, text in zip(edges[:-1], edges[1:], labels):
        inside = col > low
        if high is not None:
            inside = inside & (col <= high)
        label = F.when(inside, text) if label is None else label.when(inside, text)
    return label


def first_at_least(col: Column, steps: list[tuple], default) -> Column:
    """Value of the first (threshold, value) step the column reaches."""
    picked = None
    for threshold, value in steps:
        reached = col >= threshold
        picked = F.when(reached, F.lit(value)) if picked is None else picked.when(reached, F.lit(value))
    return picked.otherwise(F.lit(default))


def contains_any(col: Column, words: list[str]) -> Column:
    hit = col.contains(words[0])
    for word in words[1:]:
        hit = hit | col.contains(word)
    return hit


def keyword_class(text: Column, classes: list[tuple], default, empty) -> Column:
    """First keyword class found in the text, as one CASE expression."""
    lowered = F.lower(text)

    def value(v):
        return F.struct(*[F.lit(x) for x in v]) if isinstance(v, tuple) else F.lit(v)

    picked = F.when(text.isNull() | (text == ""), value(empty))
    for words, answer in classes:
        picked = picked.when(contains_any(lowered, words), value(answer))
    return picked.otherwise(value(default))


def season(month: Column) -> Column:
    return (
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.isin(3, 4, 5), "Spring")
        .when(month.isin(6, 7, 8), "Summer")
        .otherwise("Fall")
    )

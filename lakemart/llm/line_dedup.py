"""Line dedup by templates of lines.

A line's words with digits are variable from the start, if at least the share ``CONSTANT`` of
its words has none; other lines (rows of numbers) recur only where all words are equal. Leaves hold the lines with the same
number of words and the same leading words. Inside a leaf, lines in order of their first
occurrence join the earliest template whose first line they are like (share of equal words
at least ``SIMILAR``), or open a new one. A template that recurs in at least ``MIN_DOCS``
documents (``FEW_DOCS`` where it has fewer than ``FEW_WORDS`` words) is dropped everywhere
but at its first occurrence (least id, first line), so every dropped line is like a line
that stays. Documents keep their other lines.

Lines are counted before any text moves: equal lines are one row with a count, and only
leaves with several different lines are parsed. A leaf with more than ``CROWDED`` lines is
split without changing its templates: lines that are alike agree in at least one of a few
blocks of positions, so the components of equal blocks are leaves of their own. What is
still crowded goes in rounds: the first ``CROWDED`` lines are parsed by one task, all later
lines are held against the templates they opened in pieces of that size, and those without
a template yet go on. So a task holds a bounded number of lines and results do not depend
on ``CROWDED``.

Defined results: a null text stays null and has no lines; blank lines belong to no template
and stay; null ids come after all others; equal rows (same id and text) are treated alike;
an empty table gives an empty result; other columns pass through unchanged.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import WORD, release, staged, words
from lakemart.llm.components import components

MIN_DOCS = 2
FEW_WORDS = 7       # templates of fewer words ("Read more here") need FEW_DOCS documents
FEW_DOCS = 3
LEADING = 3
CROWDED = 512       # lines a task holds
SIMILAR = 0.7
CONSTANT = 0.5      # share of words without digits from which a line is a template
ANY = "<*>"


def constant(tokens: Column) -> Column:
    """Whether enough words are without digits for the others to count as fillings of a template."""
    return F.size(F.filter(tokens, lambda w: ~w.rlike("[0-9]"))) >= CONSTANT * F.size(tokens)


def masked(line: Column) -> Column:
    """Words of a line, variable where they have digits; all as they are where too few are constant."""
    plain = words(line)
    return F.when(line.rlike("[0-9]") & constant(plain), F.transform(
        plain, lambda w: F.when(w.rlike("[0-9]"), F.lit(ANY)).otherwise(w))).otherwise(plain)


def leaf(tokens: Column, leading: int) -> Column:
    return F.xxhash64(F.size(tokens), F.slice(tokens, 1, leading))


def coded(lines: list[list[str]]) -> np.ndarray:
    """Words as numbers; all lines have the same length."""
    codes: dict[str, int] = {}
    return np.array([[codes.setdefault(w, len(codes)) for w in line] for line in lines], dtype=np.int64)


def earliest(leaders: np.ndarray, row: np.ndarray, similar: float = SIMILAR) -> int:
    """Number of the first of ``leaders`` that the row is like, or -1."""
    alike = (leaders == row).mean(axis=1) >= similar
    at = int(np.argmax(alike)) if len(alike) else 0
    return at if len(alike) and alike[at] else -1


def grouped(lines: list[list[str]], similar: float = SIMILAR) -> list[int]:
    """Template number of every line of one leaf, in the given order; all lines have the same length."""
    rows = coded(lines)
    leaders = np.empty_like(rows)
    count, out = 0, []
    for row in rows:
        best = earliest(leaders[:count], row, similar)
        if best < 0:
            leaders[count] = row
            best, count = count, count + 1
        out.append(best)
    return out


def _named(pairs: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*pairs)) or [[], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["line", "template"])


def _leaves(batches: Iterator[pa.RecordBatch], solved) -> Iterator[pa.RecordBatch]:
    """What ``solved`` makes of the rows (line, tokens, leads) of each leaf and piece, which come one after the other."""
    held, key = [], None
    for batch in batches:
        out = []
        for *now, line, tokens, leads in zip(*(batch.column(c).to_pylist() for c in (
                "leaf", "piece", "line", "tokens", "leads"))):
            if now != key:
                out += solved(held) if held else []
                held, key = [], now
            held.append((line, tokens, leads))
        yield _named(out)
    if held:
        yield _named(solved(held))


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(line, template) of whole leaves; a template has the name of its first line."""
    def solved(held):
        leaders: dict[int, int] = {}
        return [(line, leaders.setdefault(k, line)) for (line, *_), k in zip(held, grouped([row[1] for row in held]))]

    return _leaves(batches, solved)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(line, template or null) of lines that follow the first lines of known templates."""
    def solved(held):
        rows, known = coded([row[1] for row in held]), sum(row[2] for row in held)
        found = [earliest(rows[:known], row) for row in rows[known:]]
        return [(row[0], held[k][0] if k >= 0 else None) for row, k in zip(held[known:], found)]

    return _leaves(batches, solved)


def parsed(found: DataFrame) -> DataFrame:
    """(line, template) of whole leaves of lines (leaf, line, first, tokens), a leaf a task's piece."""
    ordered = found.repartition("leaf").sortWithinPartitions("leaf", "first", "line")
    return ordered.select("leaf", F.lit(0).alias("piece"), "line", "tokens", F.lit(False).alias("leads")).mapInArrow(
        _parsed, "line long, template long")


def crowded(found: DataFrame) -> DataFrame:
    """(leaf, pieces) of leaves with more than CROWDED lines."""
    return staged(found.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWDED).select(
        "leaf", F.ceil(F.col("n") / CROWDED).cast("int").alias("pieces")), "crowded")


def by_blocks(found: DataFrame) -> DataFrame:
    """The lines with narrower leaves: lines of one leaf that are alike stay together.

    Of ``n`` words at most ``m`` may differ, none of them leading. So of ``m + 1`` blocks of
    the others one at least is equal in both lines; with fewer words than that, all are linked.
    """
    n = F.size("tokens")
    free, differ = n - LEADING, F.floor(n * (1 - SIMILAR) + 1e-9).cast("int")
    blocks = F.when(differ < free, differ + 1).otherwise(F.lit(1))
    at = lambda b: F.floor(b * F.col("free") / F.col("blocks")).cast("int")
    split = found.select("leaf", "line", "tokens", free.alias("free"), blocks.alias("blocks"),
                         (differ >= free).alias("all"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("b"))
    start, end = at(F.col("b")), at(F.col("b") + 1)
    keyed = staged(split.select("line", F.xxhash64("leaf", "b", F.when(
        ~F.col("all"), F.slice("tokens", start + LEADING + 1, end - start))).alias("key")), "blocks")
    least = keyed.groupBy("key").agg(F.min("line").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    named = components(keyed.join(least, "key").select(F.col("line").alias("a"), "b"))
    return found.join(named, found["line"] == named["node"], "left").select(
        F.coalesce("component", "line").alias("leaf"), "line", "first", "tokens")


def templates(found: DataFrame) -> DataFrame:
    """(line, template) of lines (leaf, line, first, tokens) that share a leaf with other lines."""
    wide = crowded(found)
    out = [parsed(found.join(wide, "leaf", "left_anti"))]
    if wide.isEmpty():
        return out[0]
    narrow = staged(by_blocks(found.join(wide, "leaf", "left_semi")), "leaves")
    wide = crowded(narrow)
    out.append(parsed(narrow.join(wide, "leaf", "left_anti")))
    rest = narrow.join(wide, "leaf", "left_semi")
    while not wide.isEmpty():
        place = F.row_number().over(Window.partitionBy("leaf").orderBy("first", "line"))
        head = staged(rest.withColumn("place", place).where(F.col("place") <= CROWDED).drop("place"), "heads")
        opened = staged(parsed(head), "opened")
        out.append(opened)
        leaders = head.join(opened.where("line = template").select("line"), "line", "left_semi")
        later = rest.join(head.select("line"), "line", "left_anti")
        columns = ["leaf", "piece", "first", "line", "tokens", "leads"]
        pieces = leaders.join(wide, "leaf").withColumn("leads", F.lit(True)).withColumn(
            "piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).select(*columns).union(
            later.join(wide, "leaf").withColumn("leads", F.lit(False)).withColumn(
                "piece", F.pmod("line", "pieces").cast("int")).select(*columns))
        held = staged(pieces.repartition("leaf", "piece").sortWithinPartitions(
            "leaf", "piece", F.desc("leads"), "first", "line").mapInArrow(_joined, "line long, template long"), "joined")
        out.append(held.where("template is not null"))
        rest = staged(later.join(held.where("template is null").select("line"), "line", "left_semi"), "later")
        wide = crowded(rest)
        out.append(parsed(rest.join(wide, "leaf", "left_anti")))
        rest = rest.join(wide, "leaf", "left_semi")
    return functools.reduce(DataFrame.union, out)


def needed(size: Column, min_docs: int = MIN_DOCS) -> Column:
    """Documents in which a template of so many words recurs."""
    return F.when(size < FEW_WORDS, F.lit(max(min_docs, FEW_DOCS))).otherwise(F.lit(min_docs))


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, tie, spots): positions of the lines that go, by row of (doc_id, text)."""
    tied = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    exploded = tied.select("doc_id", "tie", F.posexplode(F.split("text", "\n")).alias("spot", "words"))
    tokens = exploded.withColumn("tokens", masked(F.col("words"))).where(F.size("tokens") > 0)
    line = F.xxhash64(F.size("tokens"), "tokens")
    least = needed(F.col("size"), min_docs)
    # lines of mostly numbers have a leaf each, so that only equal ones recur
    lines = staged(tokens.select("doc_id", "tie", "spot", F.size("tokens").alias("size"), line.alias("line"), F.when(
        F.col("words").rlike("[0-9]") & ~constant(F.col("tokens")), line).otherwise(
            leaf(F.col("tokens"), LEADING)).alias("leaf")), "lines")
    # a document counts once for a line; equal rows are told apart by nothing and count once
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "tie", "spot")
    known = lines.groupBy("leaf", "line", "size", "doc_id", "tie").agg(F.min(first).alias("first"))
    known = staged(known.groupBy("leaf", "line", "size").agg(F.count(F.lit(1)).alias("docs"), F.min("first").alias("first")),
                   "distinct_lines")
    shared = known.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.sum("docs").alias("d"), F.min("size").alias("size")).where(
        (F.col("n") > 1) & (F.col("d") >= least))
    several = known.join(shared.select("leaf"), "leaf", "left_semi")
    wanted = several.groupBy("first.doc_id", "first.tie").agg(
        F.collect_list(F.struct("leaf", "line", "first")).alias("wanted")).alias("w")
    same = tied["doc_id"].eqNullSafe(F.col("w.doc_id")) & (tied["tie"] == F.col("w.tie"))
    texts = tied.join(wanted, same).select(F.split("text", "\n").alias("all"), F.explode("wanted").alias("x"))
    found = staged(texts.select("x.leaf", "x.line", "x.first", masked(F.get("all", F.col("x.first.spot"))).alias(
        "tokens")).dropDuplicates(["line"]), "line_words")
    release(docs.sparkSession)
    named = templates(found)
    of_line = staged(known.select("line").join(named, "line", "left").select(
        "line", F.coalesce("template", "line").alias("template")), "templates")
    release(docs.sparkSession)
    # where every line is its own template its counts are those of the template
    placed = known.join(of_line, "line")
    totals = placed.groupBy("template").agg(
        F.sum("docs").alias("most"), F.min("size").alias("size"), F.min("first").alias("first")).where(
        F.col("most") >= least).select("template", "first", least.alias("least"))
    marked = lines.join(placed.select("line", "template"), "line").join(totals, "template")
    holders = marked.select("template", "least", "doc_id", "tie").distinct().groupBy("template", "least").agg(
        F.count(F.lit(1)).alias("docs")).where(F.col("docs") >= F.col("least"))
    gone = marked.join(holders, "template", "left_semi").where(
        ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("tie") == F.col("first.tie"))
          & (F.col("spot") == F.col("first.spot"))))
    return gone.groupBy("doc_id", "tie").agg(F.collect_set("spot").alias("spots"))


def drop_templates(docs: DataFrame, min_docs: int = MIN_DOCS, counts: bool = True,
                   drop_emptied: bool = False) -> DataFrame:
    """All rows and columns of ``docs``, text without recurring lines.

    ``counts`` adds n_lines and n_dropped, in place of columns of these names.
    ``drop_emptied`` leaves out rows whose every word went with dropped lines.
    """
    gone = dropped_lines(docs.select("doc_id", "text"), min_docs).select(
        F.col("doc_id").alias("__id"), F.col("tie").alias("__tie"), F.col("spots").alias("__spots"))
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*others).alias("__doc"), "doc_id", "text")
    joined = rows.join(
        gone, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__tie")), "left")
    cut = joined.withColumn("__lines", F.split("text", "\n"))
    spots = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__spots"))
    kept = F.array_join(F.transform(spots, lambda i: F.get("__lines", i)), "\n")
    made = cut.withColumn("__text", F.when(F.col("__spots").isNull(), F.col("text")).otherwise(kept))
    if drop_emptied:
        made = made.where(F.col("__spots").isNull() | F.col("__text").rlike(WORD))
    added = ["n_lines", "n_dropped"] if counts else []
    out = [(F.col("__text") if c == "text" else F.col(f"__doc.`{c}`")).alias(c) for c in docs.columns if c not in added]
    if counts:
        out.append(F.coalesce(F.size("__lines"), F.lit(0)).cast("long").alias("n_lines"))
        out.append(F.coalesce(F.size("__spots"), F.lit(0)).cast("long").alias("n_dropped"))
    return made.select(*out)

"""Interaction of document filters: what each removes in every order of application.

Filters, with their bits:

* A (1): fewer than 50 words;
* B (2): 100 * distinct words < 65 * words;
* C (4): 100 * letters A-Z > 5 * code points;
* D (8): holds one of ``#$%&*|``;
* E (16): the text is that of a smaller doc_id, anywhere in the table.

E is an existential self-join: rows meet on a 64-bit digest of the text, then on the text
itself, and stay if a smaller id is there. Texts move once, by digest and in the same way at
every size, to find those whose digest two ids share; only these meet each other. The side
that is looked up holds one row per text, folded before the shuffle, so a text that fills a
third of the table costs one row there; its many rows on the other side are those of a
skewed join, which adaptive execution splits. The ids so marked are
united with the failures of the other filters, folded to one bit set per document, and
counted by part and bit set. All 120 orders follow from these at most 32 counts a part.

Defined results: a null or empty text has no words, fails A and is equal to other empty
texts; a null source is the part named by the empty string; a null id is neither smaller nor
larger than another, so it is never a copy and makes none; repeated rows of one id are
documents of their own and no copies of each other; a label holds for every row of its id,
and of several labels of an id one is enough; an empty table has no parts. Other columns are
ignored.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import staged, words

# The filters' limits and letters.
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_CAPITALS_PERCENT = 5
SYMBOLS = r"[#$%&*|]"
FILTERS = "ABCDE"
BIT = {letter: 1 << i for i, letter in enumerate(FILTERS)}
COPY = BIT["E"]


def measured(docs: DataFrame) -> DataFrame:
    """One narrow row per document: id, part, digest of the text, bits of the failures A to D."""
    held = docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    split = held.withColumn("w", words(F.col("text")))
    n = F.size("w")
    failures = {
        "A": n < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct("w")) < MIN_DISTINCT_PERCENT * n,
        "C": 100 * F.regexp_count("text", F.lit("[A-Z]")) > MAX_CAPITALS_PERCENT * F.char_length("text"),
        "D": F.col("text").rlike(SYMBOLS),
    }
    bits = [F.when(test, BIT[letter]).otherwise(0) for letter, test in failures.items()]
    return split.select("doc_id", "part", F.xxhash64("text").alias("digest"), sum(bits[1:], bits[0]).alias("failed"))


def copies(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows (doc_id, part, digest) whose text a smaller id has too."""
    shared = rows.groupBy("digest").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    texts = staged(
        docs.where(F.col("doc_id").isNotNull()).select(
            "doc_id", F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("digest", F.xxhash64("text")).join(shared.hint("merge"), "digest", "left_semi"),
        "audit_texts")
    # written, so that both sides of the join below are plain shuffles, of which a hot one can be split
    least = staged(texts.groupBy("digest", "text").agg(F.min("doc_id").alias("smaller")), "audit_least")
    same = (F.col("d.digest") == F.col("s.digest")) & (F.col("d.text") == F.col("s.text"))
    return texts.alias("d").join(
        least.alias("s"), same & (F.col("s.smaller") < F.col("d.doc_id")), "left_semi").select("doc_id", "part", "digest")


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents per part, set of failures and labels: part, failed, good, toxic, n."""
    rows = staged(measured(docs), "audit_rows")
    others = rows.groupBy("doc_id", "part", "digest", "failed").agg(F.count(F.lit(1)).alias("n"))
    marked = copies(docs, rows).distinct().select(
        "doc_id", "part", "digest", F.lit(COPY).alias("failed"), F.lit(0).cast("long").alias("n"))
    per_doc = others.unionByName(marked).groupBy("doc_id", "part", "digest").agg(
        F.bit_or("failed").alias("failed"), F.sum("n").alias("n"))
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    no = F.lit(False)
    return per_doc.join(known, "doc_id", "left").groupBy(
        "part", "failed", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic")
    ).agg(F.sum("n").alias("n"))


def _places() -> dict[tuple[int, int], list[tuple[str, int]]]:
    """(filter's bit, bits applied before it) -> the orders and steps where that happens."""
    found: dict[tuple[int, int], list[tuple[str, int]]] = {}
    for order in itertools.permutations(FILTERS):
        for i, letter in enumerate(order):
            before = sum(BIT[x] for x in order[:i])
            found.setdefault((BIT[letter], before), []).append(("".join(order), i + 1))
    return found


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, with what the step keeps, removes and costs."""
    places = _places()
    sets = F.array(*[F.struct(F.lit(own).alias("own"), F.lit(before).alias("before")) for own, before in places])
    failed, own, before = F.col("failed"), F.col("own"), F.col("before")
    fails = failed.bitwiseAND(own) != 0
    gone = failed.bitwiseAND(before) != 0
    removed = fails & ~gone
    share = F.lit(len(places[BIT["A"], 0]) * len(FILTERS)) / F.bit_count("failed")     # 120 orders, dealt evenly

    def count(test, weight=F.col("n")):
        return F.sum(F.when(test, weight).otherwise(0)).cast("long")

    counts = (
        staged(combinations(docs, labels), "audit_counts")
        .select("*", F.explode(sets).alias("at")).select("*", "at.own", "at.before")
        .groupBy("part", "own", "before").agg(
            count(failed.bitwiseAND(own.bitwiseOR(before)) == 0).alias("kept"),
            count(removed).alias("removed"),
            count(fails & gone).alias("redundant"),
            count(failed == own).alias("unique_fails"),
            count(removed & F.col("good")).alias("good_lost"),
            count(removed & F.col("toxic")).alias("toxic_lost"),
            count(fails, F.col("n") * share.cast("long")).alias("shapley"),
        )
    )
    orders = F.create_map(*[x for (bit, earlier), where in places.items() for x in (
        F.lit(32 * earlier + bit),
        F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step")) for o, s in where]))])
    return counts.withColumn("x", F.explode(F.element_at(orders, 32 * before + own))).select(
        "part", "x.filter_order", "x.step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
        "shapley")

"""Quality rules with verdicts per host.

Each text is measured and held against base rules. Failures are summed by host (the
document's source), each host's failure rate is shrunk towards the rate of all hosts
by a beta prior fitted to the hosts themselves, and hosts above a limit take all their
documents with them.

Everything is built from column functions. Words in repeated windows are found by
sorting the windows of one text, so no window leaves its row and nothing is shuffled
but one count per host. A host with a third of all rows is one row after the partial
sums; the join back is left to adaptive execution, which splits a hot host.

Defined results: a null or empty text has no words and fails the base rule; a null
source is a host of its own; an empty table gives an empty result; hosts that all have
the same rate keep it (the prior is then a point).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import WORD, words

MIN_WORDS = 50
MAX_REPEAT_SHARE = 50      # percent of words in windows seen twice
SYMBOLS = "#*$%&|<>"       # fixed value
WINDOW = 3
MAX_HOST_RATE = 0.5        # shrunk failure rate above which a host is rejected


def _tripled(spots: Column) -> Column:
    """Words covered by windows that start at the sorted ``spots``."""
    return F.aggregate(
        spots,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, at: F.struct(
            (acc["n"] + F.least(F.lit(WINDOW), at - acc["last"])).cast("long").alias("n"), at.alias("last")),
        lambda acc: acc["n"],
    )


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    whole = F.coalesce(F.col(text), F.lit(""))
    split = docs.withColumn("__w", words(F.col(text)))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(WORD))
    counted = split.withColumns({
        "n_words": F.size("__w").cast("long"),
        "word_chars": F.aggregate("__w", F.lit(0).cast("long"), lambda a, w: a + F.length(w)),
        "n_symbols": (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long"),
        "__lines": lines,
        "__h": F.transform("__w", lambda w: F.xxhash64(w)),
    }).drop("__w")
    # windows as (digest, start), sorted: equal windows become neighbours
    spans = F.transform(
        F.slice("__h", 1, F.greatest(F.size("__h") - (WINDOW - 1), F.lit(0))),
        lambda h, i: F.struct(
            F.xxhash64(h, F.get("__h", i + 1), F.get("__h", i + 2)).alias("h"), i.alias("at")),
    )
    ordered = counted.withColumns({
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "__s": F.sort_array(spans),
    }).drop("__lines", "__h")
    twice = F.filter(
        "__s",
        lambda x, i: F.coalesce(F.get("__s", i - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get("__s", i + 1)["h"] == x["h"], F.lit(False)),
    )
    spots = F.sort_array(F.transform(twice, lambda x: x["at"]))
    return ordered.withColumn("n_repeat_words", _tripled(spots)).drop("__s")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_SHARE * F.col("n_words"))


def host_verdicts(judged: DataFrame, host: str, limit: float = MAX_HOST_RATE) -> DataFrame:
    """One row per host: documents, failures, shrunk rate and verdict.

    The prior's mean is the mean of the hosts' rates; its strength follows from their
    spread (moments of a beta law). Hosts without spread give an infinitely strong prior.
    """
    hosts = judged.groupBy(host).agg(
        F.count(F.lit(1)).alias("docs"),
        F.sum(F.col("base_failed").cast("long")).alias("failed"),
    )
    rate = F.col("failed") / F.col("docs")
    moments = hosts.agg(F.avg(rate).alias("m"), F.var_pop(rate).alias("v"))
    prior = moments.select(F.struct(
        "m",
        F.when(F.col("v") > 0, F.greatest(F.col("m") * (1 - F.col("m")) / F.col("v") - 1, F.lit(0.0))).alias("n"),
    ).alias("p")).scalar()
    known = hosts.withColumn("__p", prior)
    shrunk = F.when(F.col("__p.n").isNull(), F.col("__p.m")).otherwise(
        (F.col("failed") + F.col("__p.m") * F.col("__p.n")) / (F.col("docs") + F.col("__p.n")))
    return known.withColumn("rate", shrunk).withColumn("host_ok", F.col("rate") <= limit).drop("__p")


def verdicts(measures: DataFrame, host: str, limit: float = MAX_HOST_RATE) -> DataFrame:
    """Measured rows with ``base_failed`` and ``kept``; read twice, so give a written table."""
    judged = measures.withColumn("base_failed", base_failed())
    hosts = host_verdicts(judged, host, limit).select(F.col(host).alias("__host"), "host_ok")
    joined = judged.join(hosts, F.col(host).eqNullSafe(F.col("__host")), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & F.col("host_ok")).drop("__host", "host_ok")

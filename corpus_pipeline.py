"""A corpus pipeline: documents through the text operators, stage by stage."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import bpe, line_dedup, mixing, ngram_join, quality_rules
from lakemart.llm.common import release, staged, table
from lakemart.llm.queries import vocabulary


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule, or whose host is rejected, go."""
    whole = docs.select(F.struct(*docs.columns).alias("__doc"), "source", "text")
    measured = staged(quality_rules.measured(whole).drop("text"), "pipeline_rules")
    return quality_rules.verdicts(measured, host="source").where("kept").select("__doc.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring line templates go but for their first occurrence; so do documents left without a word by that."""
    return line_dedup.drop_templates(docs, counts=False, drop_emptied=True)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked rows one stays: that with the least id (null ids last), of repeated rows the first."""
    held = staged(docs.select(F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("row")), "rows")
    linked = staged(ngram_join.similar_components(held.select(F.col("row").alias("doc_id"), "doc.text")), "row_groups")
    release(spark)
    order = F.struct(F.col("doc.doc_id").isNull().alias("unnamed"), F.col("doc.doc_id").alias("doc_id"), "row")
    named = held.select("row", order.alias("order")).join(linked.select(F.col("doc_id").alias("row"), "component_id"), "row")
    firsts = named.groupBy("component_id").agg(F.min("order")["row"].alias("kept"))
    others = staged(named.join(firsts, "component_id").where("row != kept").select("row"), "copies")
    release(spark)
    return held.join(others, "row", "left_anti").select("doc.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: rows beyond a budget go, rows below it repeat."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text as tokens, by number and digest."""
    return bpe.encode_decode(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", rules),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources to target weights", mix),
    ("BPE encoding and decoding", tokens),
]

ORACLE_SQL = None  # line templates and byte-pair merges are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written and read back as the next one's input."""
    first = table(spark, sf_dir, "documents")
    written = functools.reduce(
        lambda docs, stage: staged(stage[1](spark, docs, sf_dir), "pipeline_stage"), STAGES[:-1], first)
    return STAGES[-1][1](spark, written, sf_dir)

"""The registered queries of the text operators, each over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import (
    bpe, centroids, filter_audit, fingerprints, line_dedup, mixing, ngram_join, packing, quality_model, quality_rules,
    sharding, suffix_dedup, warc)
from lakemart.llm.common import fresh_path, staged, table


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file: in the folder TOKENIZERS_DIR, else where its package says."""
    folder = os.environ.get("TOKENIZERS_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_sharding(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents"), shards=24)


@query
def op5_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    measured = staged(quality_rules.measured(docs).drop("text"), "rule_measures")
    return quality_rules.verdicts(measured, host="source").drop("source")


@query
def op7_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.plan(docs).drop("key", "tie", "copies", "part")


@query
def op10_fingerprints(spark, sf_dir):
    return fingerprints.fingerprint_pairs(table(spark, sf_dir, "documents"))


@query
def op9_ngram_join(spark, sf_dir):
    return ngram_join.similar_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op2_bpe(spark, sf_dir):
    return bpe.encode_decode(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@query
def op8_warc(spark, sf_dir):
    path = fresh_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    # responses are read with their payloads, which are checked; of revisits only headers are parsed
    responses = warc.read_archives(spark, path, payload=True).where("record_type = 'response'")
    revisits = warc.read_archives(spark, path).where("record_type = 'revisit'")
    return responses.withColumn("payload_bytes", F.length("payload").cast("long")).select(*columns).union(
        revisits.select(*columns))


@query
def op6_suffix_dedup(spark, sf_dir):
    left = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    # a removed run may begin or end inside a character: the digest speaks of the bytes, the text is made valid
    return left.withColumns({
        "n_kept": F.col("n_bytes") - F.col("n_removed"),
        "kept_text": F.make_valid_utf8(F.col("kept").cast("string")),
    }).drop("kept")


@query
def op3_quality_model(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_model.score(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))


@query
def op4_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_templates(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


@query
def op11_best_fit_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.token_pieces(docs, vocabulary("byte_bpe_50k.json"), end=2, capacity=1024)
    return packing.pack(pieces, capacity=1024)


@query
def op12_filter_audit(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return filter_audit.audit(docs, table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))


@query
def op13_centroid_clustering(spark, sf_dir):
    return centroids.cluster(table(spark, sf_dir, "embeddings"), k=8, rounds=10, width=64, prefix="3:")

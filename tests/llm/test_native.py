"""Sharding, quality rules and mixing against plain restatements, over edge rows and the smallest tables."""

import collections
import re
import zlib

import duckdb
import pandas as pd
import pytest

from lakemart.llm import mixing, quality_rules, sharding
from lakemart.llm.oracle import SQL
from lakemart.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("shards", [1, 3, 24])
def test_shards_hold_every_row_once(edge_docs, edge_rows, shards):
    rows = sharding.shard(edge_docs, shards).collect()
    assert len(rows) == len(edge_rows)
    slots = collections.defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    expected = sorted((str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in edge_rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == expected


def test_shards_balance_and_keep_groups(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = sharding.shard(docs, 4).collect()
    load, homes = collections.Counter(), collections.defaultdict(set)
    for r in rows:
        load[r.shard] += r.size
        homes[r.text_crc32].add(r.shard)
    assert max(load.values()) - min(load.values()) < 0.01 * sum(load.values())
    assert sum(len(h) > 1 for h in homes.values()) <= 1


def test_hot_text_is_split_over_shards(spark):
    docs = spark.range(600).selectExpr("id as doc_id", "if(id < 400, repeat('same ', 40), concat('own ', id)) as text")
    load = collections.Counter()
    for r in sharding.shard(docs, 8).collect():
        load[r.shard] += r.size
    assert max(load.values()) - min(load.values()) <= 2 * 208


def _measures(text):
    found = WORD.findall(text or "")
    grams = collections.Counter(zip(found, found[1:], found[2:]))
    covered = {i + k for i in range(len(found) - 2) if grams[tuple(found[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    n = len(found)
    return (n, sum(map(len, found)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def test_rules_measure_every_text(edge_docs, edge_rows):
    measured = quality_rules.measured(edge_docs.select("doc_id", "source", "text"))
    rows = quality_rules.verdicts(measured, "source").collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = sorted((str(r.doc_id), *(r[n] for n in names)) for r in rows)
    assert got == sorted((str(i), *_measures(t)) for i, t, *_ in edge_rows)
    assert all(not r.kept for r in rows if r.base_failed)


def test_bad_host_takes_its_documents_along(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, good if i % 10 else "short", "good") for i in range(200)] + [
        (1000 + i, good if i % 10 == 0 else "short", "bad") for i in range(200)]
    measured = quality_rules.measured(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    kept = {r.doc_id: r.kept for r in quality_rules.verdicts(measured, "source").collect()}
    assert sum(kept[i] for i in range(200)) == 180
    assert not any(kept[1000 + i] for i in range(200))


def _targets(sizes):
    total, weight, capped = sum(sizes.values()), {}, {}
    for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or ""))):
        weight[s] = k % 3 + 1
    left = set(sizes)
    share = {}
    while left:
        rest = total - sum(capped.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = {s for s in left if share[s] > 3 * sizes[s]}
        if not over:
            break
        capped.update({s: 3 * sizes[s] for s in over})
        left -= over
    return {**share, **capped}


def test_mix_meets_every_budget(edge_docs, edge_rows):
    rows = mixing.plan(edge_docs).collect()
    assert len(rows) == len(edge_rows)
    sizes, taken = collections.Counter(), collections.Counter()
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r["size"]
    expected = _targets(dict(sizes))
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - expected[r.source]) < 1e-6
    assert all(abs(taken[s] - expected[s]) <= 1 for s in sizes)
    assert sorted(map(str, mixing.plan(edge_docs.repartition(5)).collect())) == sorted(map(str, rows))


def test_mixed_rows_follow_the_plan(edge_docs):
    mixed = mixing.mix(edge_docs)
    assert mixed.columns == edge_docs.columns
    rows = edge_docs.collect()
    # whole rows only, each at most three times as often as it is there
    there, out = collections.Counter(map(str, rows)), collections.Counter(map(str, mixed.collect()))
    assert set(out) <= set(there) and all(out[r] <= 3 * there[r] for r in out)
    for r in mixing.plan(edge_docs).collect():
        assert 0 <= r.taken <= 3 * r.size


def test_equal_rows_and_clashing_names_meet_the_budget(spark):
    rows = [("a", 1, "word " * 40)] * 50 + [("b", i, "own " * 30 + str(i)) for i in range(80)] + [("c", 999, "z " * 20)] * 7
    docs = spark.createDataFrame([(s, i, t, 5, 6) for s, i, t in rows],
                                 "source string, doc_id long, text string, row int, __tie int").repartition(4)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    taken = collections.Counter()
    for r in mixed.collect():
        assert (r.row, r["__tie"]) == (5, 6)
        taken[r.source] += len(r.text.split())
    for r in mixing.plan(docs).groupBy("source").agg({"target": "max", "size": "max"}).collect():
        assert abs(taken[r.source] - r["max(target)"]) <= r["max(size)"] / 2 + 1


def test_empty_tables(no_docs):
    assert sharding.shard(no_docs, 24).collect() == []
    assert mixing.plan(no_docs).collect() == [] and mixing.mix(no_docs).collect() == []
    measured = quality_rules.measured(no_docs.select("doc_id", "source", "text"))
    assert quality_rules.verdicts(measured, "source").collect() == []


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_dir, name):
    database = duckdb.connect()
    for table in ("documents", "pages", "labels"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    df = QUERIES[name](spark, sf_dir)
    expected = database.execute(SQL[name]).df()
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)

    def rows(frame):
        return sorted(tuple("" if pd.isna(v) else v for v in row) for row in frame[columns].itertuples(index=False))

    assert rows(df.toPandas()) == rows(expected)

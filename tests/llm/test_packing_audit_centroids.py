"""Packing, filter audit and centroid clustering against plain restatements, over edge rows and the smallest tables."""

import collections
import hashlib
import itertools
import json
import re
import zlib

import numpy as np
import pytest

from lakemart.llm import bpe, centroids, filter_audit, packing
from lakemart.llm.queries import QUERIES, vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BPE = "byte_bpe_50k.json"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary(BPE))


# --- packing ---

def _check_packing(rows, texts, tokenizer, capacity):
    """Every document cut by the rules, every sequence gapless and within the capacity; returns their number."""
    of_doc, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        of_doc[r.doc_id].append((r.start, r.length, r.ids_crc32, r.piece))
        sequences[r.sequence_id].append((r.offset, r.length))
    expected = collections.defaultdict(list)
    for doc_id, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % capacity or capacity
        for piece, start in enumerate([0, *range(first, len(ids), capacity)]):
            own = ids[start:first] if not piece else ids[start:start + capacity]
            expected[doc_id].append((start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()), piece))
    assert {k: sorted(v) for k, v in of_doc.items()} == {k: sorted(v) for k, v in expected.items()}
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def _best_fit(sizes, capacity):
    """Sequences used by best fit, one piece after the other, largest first."""
    gaps = np.zeros(capacity + 1, dtype=int)
    used = 0
    for s in sorted(sizes, reverse=True):
        fits = np.flatnonzero(gaps[s:])
        if len(fits):
            gaps[s + fits[0]] -= 1
            gaps[fits[0]] += 1
        else:
            used += 1
            gaps[capacity - s] += 1
    return used


@pytest.mark.parametrize("capacity", [8, 64, 1024])
def test_pieces_and_sequences_of_edge_rows(edge_docs, edge_rows, tokenizer, capacity):
    rows = packing.pack(packing.token_pieces(edge_docs, vocabulary(BPE), 2, capacity), capacity).collect()
    used = _check_packing(rows, [r[:2] for r in edge_rows], tokenizer, capacity)
    assert used <= 1.02 * _best_fit([r.length for r in rows], capacity) + 1


def test_query_packs_the_whole_table(spark, sf_dir, tokenizer):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = QUERIES["op11_best_fit_packing"](spark, sf_dir).collect()
    used = _check_packing(rows, texts, tokenizer, 1024)
    assert used <= 1.01 * _best_fit([r.length for r in rows], 1024) + 1


@pytest.mark.parametrize("lengths", [
    [300] * 400 + [10] * 400 + list(range(1, 1024, 3)), [1] * 3000, [512] * 101, [513] * 50 + [511] * 49, [1024] * 20,
    [700, 300, 24] * 200,
])
def test_packing_of_given_lengths(spark, lengths):
    items = spark.createDataFrame([(i, n, "x") for i, n in enumerate(lengths)], "row long, length long, rank string")
    rows = packing.pack(items, 1024).collect()
    assert sorted((r.row, r.length) for r in rows) == list(enumerate(lengths))
    places = collections.defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        ends = list(itertools.accumulate(n for _, n in sorted(own)))
        assert [o for o, _ in sorted(own)] == [0, *ends[:-1]] and ends[-1] <= 1024
    assert len(places) <= 1.01 * _best_fit(lengths, 1024) + 1


def test_rounds_do_not_grow_with_the_rows():
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 1024, 4000)
    rounds = []
    for times in (1, 1000):
        state = packing.Sweeps({int(s): int(n) * times for s, n in zip(*np.unique(sizes, return_counts=True))}, 1024)
        n = 0
        while any(state.waiting.values()):
            state.open()
            state.sweep()
            n += 1
        rounds.append((n, len(state.intervals)))
    assert rounds[1][0] <= rounds[0][0] + 10 and rounds[1][1] <= 3 * rounds[0][1]


def test_no_documents_and_refused_lengths(spark, no_docs):
    assert packing.pack(packing.token_pieces(no_docs, vocabulary(BPE), 2, 16), 16).collect() == []
    for bad in (0, 17, None):
        with pytest.raises(Exception, match="length outside"):
            packing.pack(spark.createDataFrame([(bad,)], "length long"), 16).collect()


def test_sequences_hold_the_documents_tokens(spark, tokenizer):
    docs = spark.createDataFrame([(i, f"text {i} " * (i % 40)) for i in range(60)], "doc_id long, text string")
    packed = packing.pack(packing.token_pieces(docs, vocabulary(BPE), 2, 32, keep_ids=True), 32).cache()
    whole = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    found = collections.defaultdict(list)
    for r in sorted(packed.collect(), key=lambda r: (r.doc_id, r.start)):
        found[r.doc_id] += whole[r.sequence_id][r.offset:r.offset + r.length]
    assert all(len(ids) <= 32 for ids in whole.values())
    assert found == {i: tokenizer.encode(f"text {i} " * (i % 40), add_special_tokens=False).ids + [2] for i in range(60)}


@pytest.mark.parametrize("by_rank", [True, False])
def test_encoder_equals_the_library_on_odd_text(tokenizer, by_rank):
    machine = packing.encoder(open(vocabulary(BPE), encoding="utf-8").read(), by_rank)
    texts = ["", " ", "\n\n  x", "a  b\t\tc   d e", "don't we'll I'M", "x<|endoftext|>y <|endoftext|>", "日本語 text é́",
             "\x00\x1c\x85 end", "١٢٣ ½ ⅷ 12ab", "😀😀 🏳️‍🌈", "a" * 300_000, "͸\U0010ffff z", "tail   ", " " * 200_000 + "x",
             "|*" * 50_000, "Ünïcödé " * 3000]
    for text in texts:
        assert np.frombuffer(machine.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_merging_by_rank_is_proved_or_left(tmp_path):
    assert packing.merges_by_rank(open(vocabulary(BPE), encoding="utf-8").read())
    assert not packing.merges_by_rank(open(vocabulary("word_bpe_49k.json"), encoding="utf-8").read())

    def small(merges, tokens):
        letters = sorted(bpe.byte_letters())
        return json.dumps({"model": {"type": "BPE", "vocab": {t: i for i, t in enumerate(letters + tokens)}, "merges": merges},
                           "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True},
                           "normalizer": None, "added_tokens": []})

    assert packing.merges_by_rank(small(["b c", "a bc"], ["bc", "abc"]))
    # "ab" joins first, so "abc" never comes about from "a" and "bc"; by rank "ab" and "c" would join
    assert not packing.merges_by_rank(small(["a b", "b c", "a bc"], ["ab", "bc", "abc"]))


# --- filter audit ---

def _audit(rows, labels):
    """Every document through every order, one filter after the other."""
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    docs = collections.defaultdict(list)
    for i, text, source in rows:
        text = text or ""
        w = WORD.findall(text)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w),
                 "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
                 "D": any(c in "#$%&*|" for c in text), "E": i is not None and least[text] < i}
        docs[source or ""].append(({x for x, bad in fails.items() if bad}, i in good, i in toxic))
    out, shapley = {}, collections.Counter()
    for part, held in docs.items():
        for order in map("".join, itertools.permutations("ABCDE")):
            left = held
            for step, x in enumerate(order, 1):
                gone = [d for d in left if x in d[0]]
                left = [d for d in left if x not in d[0]]
                out[part, order, step] = [len(left), len(gone), sum(x in d[0] for d in held) - len(gone),
                                          sum(d[0] == {x} for d in held), sum(d[1] for d in gone), sum(d[2] for d in gone)]
                shapley[part, x] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_of_edge_rows(spark, edge_docs, edge_rows):
    labels = [(i, i % 2, i % 3) for i in range(0, 20)] + [(14, 1, 1), (14, 0, None), (None, 1, 1), (999, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(edge_docs, table).collect()
    rows = [(r[0], r[1], r[2]) for r in edge_rows]
    assert {(r[0], r[1], r[2]): tuple(r[3:]) for r in got} == _audit(rows, [x for x in labels if x[0] is not None])
    assert len(got) == 600 * len({r[2] or "" for r in rows})


def test_audit_query_equals_the_restatement(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    got = {(r[0], r[1], r[2]): tuple(r[3:]) for r in QUERIES["op12_filter_audit"](spark, sf_dir).collect()}
    assert got == _audit(docs, labels)


def test_audit_of_a_hot_text_and_of_no_documents(spark, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = spark.range(3000).selectExpr(
        "id AS doc_id", "'s' AS source", "if(id % 3 = 0, repeat('same ', 9), concat('own ', id)) AS text")
    first = filter_audit.audit(docs, labels).where("filter_order = 'EABCD' AND step = 1").first()
    assert (first.removed, first.kept) == (999, 2001)
    assert filter_audit.audit(no_docs, labels).collect() == []


def test_audit_moves_texts_of_copies_only(spark, edge_docs):
    rows = filter_audit.measured(edge_docs)
    assert "text" not in rows.columns
    marked = filter_audit.copies(edge_docs, rows)
    assert "LeftSemi" in marked._jdf.queryExecution().executedPlan().toString()


# --- centroid clustering ---

def _lloyd(vectors, k, rounds, prefix):
    """Plain rounds of full scans over [(id, integers)]."""
    order = sorted(vectors, key=lambda v: (v[0] is None, hashlib.sha256(f"{prefix}{v[0]}".encode()).hexdigest()))
    centers = [list(map(int, v)) for _, v in order[:k]]
    for step in range(rounds + 1):
        spread = [[sum((a - b) ** 2 for a, b in zip(map(int, v), c)) for c in centers] for _, v in vectors]
        own = [d.index(min(d)) for d in spread]
        if step < rounds:
            for j in range(len(centers)):
                mine = [v for (_, v), o in zip(vectors, own) if o == j]
                if mine:
                    centers[j] = [int(sum(int(v[i]) for v in mine)) // len(mine) for i in range(len(mine[0]))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    inertia = collections.Counter()
    for o, d in zip(own, spread):
        inertia[o] += d[o]
    return sorted((str(v[0]), o, d[o], inertia[o], sum(inertia.values()), digests[o])
                  for v, o, d in zip(vectors, own, spread))


def _rows(df):
    return sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


def test_clusters_of_the_table(spark, sf_dir):
    held = [(r.vec_id, np.floor(1024 * np.array(r.embedding, np.float64)).astype(int))
            for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert _rows(QUERIES["op13_centroid_clustering"](spark, sf_dir)) == _lloyd(held, 8, 10, "3:")


def test_bounds_save_measurements_and_change_nothing(spark):
    rng = np.random.default_rng(1)
    data = [(i, (rng.normal(0, .02, 4) + 3 * (i % 5)).tolist()) for i in range(900)]
    rows = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(5)
    work = []
    got = _rows(centroids.cluster(rows, 5, 12, 4, "x", work))
    assert got == _lloyd([(i, np.floor(1024 * np.array(v)).astype(int)) for i, v in data], 5, 12, "x")
    assert work[0] == 900 * 5 and work[-2] < 900 * 5 / 4


def test_clusters_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, -0.25]), (1, [0.5, -0.25]), (2, [0.5, -0.25]), (None, [7.0, 7.0]), (4, [1e-9, -1e-9]), (5, [3.0, 2.0])]
    bad = [(6, None), (7, []), (8, [1.0]), (9, [1.0, None]), (10, [nan, 1.0]), (11, [inf, 1.0]), (12, [1.0, 2.0, 3.0])]
    rows = spark.createDataFrame([(i, v, 1, b"v") for i, v in good + bad],
                                 "vec_id long, embedding array<double>, cluster int, vec binary")
    whole = [(i, np.floor(1024 * np.array(v)).astype(int)) for i, v in good]
    for k in (1, 3, 20):
        assert _rows(centroids.cluster(rows, k, 4, 2, "3:")) == _lloyd(whole, k, 4, "3:")
    assert centroids.cluster(rows.where("vec_id > 5"), 3, 2, 2, "3:").collect() == []
    assert centroids.cluster(rows.limit(0), 3, 2, 2, "3:").collect() == []
    with pytest.raises(Exception, match="too large"):
        centroids.cluster(spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<double>"), 1, 1, 2, "3:")


def test_equal_vectors_in_equal_distance_take_the_smaller_number(spark):
    rows = spark.createDataFrame([(i, [float(i % 2)]) for i in range(400)], "vec_id long, embedding array<double>")
    got = _rows(centroids.cluster(rows, 6, 3, 1, "3:"))
    assert got == _lloyd([(i, [1024 * (i % 2)]) for i in range(400)], 6, 3, "3:")

"""Tokens against the public library, the classifier on held-out rows, archives by round trip, the pipeline by stage."""

import base64
import collections
import gzip
import hashlib
import io
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lakemart.llm import bpe, kernels, quality_model, warc
from lakemart.llm.queries import QUERIES, vocabulary

VOCABULARY = vocabulary("byte_bpe_50k.json")


# --- tokens ------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def test_automaton_equals_the_library(library):
    with open(VOCABULARY, encoding="utf-8") as file:
        machine = bpe.Automaton(file.read())
    draw = random.Random(3)
    letters = list("abcdefghijklmnopqrstuvwxyzABC   \n\t'.,!1290éñßçü中文😀 \x1c\x85​　\r\x0b") + [
        "<|endoftext|>", "the", "ing", "'ll", "'S"]
    texts = ["".join(draw.choice(letters) for _ in range(draw.randrange(60))) for _ in range(3000)]
    texts += ["a" * 5000, "aA" * 300, " " * 700, "\n" * 99 + "x", "ab" * 3000, "<|endoftext|><|endoftext|> a", ""]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert machine.encode(text) == ids
        assert machine.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_small_automata_follow_the_merges():
    draw = random.Random(9)
    letters = bpe.byte_letters()
    for _ in range(60):
        vocab, merges = {c: i for i, c in enumerate(letters)}, []
        parts = list("ab")
        for _ in range(12):
            u, v = draw.choice(parts), draw.choice(parts)
            if u + v not in vocab:
                vocab[u + v] = len(vocab)
                merges.append(f"{u} {v}")
                parts.append(u + v)
        model = {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False}, "normalizer": None,
                 "model": {"vocab": vocab, "merges": merges}}
        import json

        machine = bpe.Automaton(json.dumps(model))
        names = {i: t for t, i in vocab.items()}
        for _ in range(30):
            word = [draw.choice("ab") for _ in range(draw.randrange(1, 14))]
            expected = list(word)
            for merge in merges:
                u, v = merge.split(" ")
                at = 0
                while at < len(expected) - 1:
                    if expected[at] == u and expected[at + 1] == v:
                        expected[at:at + 2] = [u + v]
                    at += 1
            assert [names[i] for i in machine.encode_word("".join(word).encode())] == expected


def test_documents_are_encoded_whole(edge_docs, edge_rows, no_docs, library):
    def row(i, text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        return str(i), len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))

    rows = bpe.encode_decode(edge_docs, VOCABULARY, keep_ids=True).collect()
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows)
    assert got == sorted(row(i, t) for i, t, *_ in edge_rows)
    assert all(len(r.ids) == r.n_tokens for r in rows)
    assert bpe.encode_decode(no_docs, VOCABULARY).collect() == []


# --- classifier ----------------------------------------------------------------------------
def _labelled(spark, n=700):
    draw = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        good = draw.random() < 0.7
        words = [draw.choice(["river", "stone", "cloud", "field", "light", "paper"]) for _ in range(draw.randrange(20, 60))]
        text = " ".join(words) if good else " ".join(w + draw.choice(["%%%", "$$$", "###"]) for w in words)
        rows.append((i, text))
        if i % 2 == 0:
            labels.append((i, int(good)))
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int"))


def test_held_out_documents_are_told_apart(spark):
    docs, labels = _labelled(spark)
    rows = {r.doc_id: r for r in quality_model.score(docs, labels).collect()}
    held = [r for r in labels.collect() if rows[r.doc_id].held_out]
    assert len(held) > 40
    assert np.mean([rows[r.doc_id].predicted == r.quality for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows.values())
    again = {r.doc_id: r.score for r in quality_model.score(docs.repartition(5), labels.repartition(3)).collect()}
    assert max(abs(again[i] - rows[i].score) for i in again) < 1e-4


def _plain_tokens(text):
    kind = lambda c: 0 if c.isspace() else 1 if c.isalpha() else 2 if c.isdigit() else 3
    return ["".join(g) for k, g in itertools.groupby(text.lower(), kind) if k]


def _digest(token):
    data = np.frombuffer(token.encode(), dtype=np.uint8)
    return int(quality_model.tokens(data, np.array([0, len(data)]))[0][0])


def _plain_index(token):
    places, signs = quality_model.index_entries(np.array([_digest(token)], dtype=np.uint64))
    out = np.zeros(quality_model.WIDTH)
    for place, sign in zip(places[0], signs[0]):
        out[place] += sign
    return out


def test_vectors_and_pooling_restated(spark):
    draw = random.Random(9)
    known = [f"word{draw.randrange(50)}" for _ in range(40)] + ["River", "##", "|", "42", "stone"]
    texts = [" ".join(draw.choice(known) for _ in range(draw.randrange(1, 40))) for _ in range(60)] + ["", "one", "a\na\nb|b"]
    contexts, counts = collections.defaultdict(lambda: np.zeros(quality_model.WIDTH)), collections.Counter()
    for text in texts:
        row = _plain_tokens(text)
        counts.update(row)
        for i, token in enumerate(row):
            for j in range(max(0, i - quality_model.REACH), min(len(row), i + quality_model.REACH + 1)):
                if j != i:
                    contexts[token] = contexts[token] + _plain_index(row[j])
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    tables = quality_model.word_tables(docs)
    names = sorted(counts)
    vectors, weights = quality_model.word_vectors(np.array([_digest(n) for n in names], dtype=np.uint64), *tables)
    unit = {}
    for name, vector, weight in zip(names, vectors, weights):
        want = np.sign(contexts[name]) * np.log1p(np.abs(contexts[name]))
        unit[name] = want / max(np.linalg.norm(want), 1e-9)
        assert np.allclose(vector, unit[name], atol=1e-6)
        assert weight == pytest.approx(1 / (1 + 1000 * counts[name] / sum(counts.values())))
    weigh = dict(zip(names, weights))
    for text in texts:
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        got = quality_model.features(data, np.array([0, len(data)]), *tables)[0]
        row = _plain_tokens(text)
        if not row:
            assert not got.any()
            continue
        pooled = sum(unit[t] * weigh[t] for t in row) / sum(weigh[t] for t in row)
        lines = text.split("\n")
        letters = sum(c.isalpha() for c in text)
        shares = [np.log1p(len(row)) / 10, len(set(row)) / len(row), sum(c.isupper() for c in text) / len(text),
                  letters / len(text), sum(not c.isspace() and not c.isalpha() for c in text) / len(text),
                  len(set(lines)) / len(lines), letters / len(row) / 10]
        assert np.allclose(got, [*pooled, *(sum(map(_plain_index, row)) / len(row)), *shares], atol=1e-5)


def test_rare_words_keep_vectors_of_their_own():
    """Far more words than table rows: a rare word's vector and weight are near its own, not its neighbours' in a row."""
    draw = np.random.default_rng(3)
    many = 4 * quality_model.ROWS
    names = draw.integers(1, 1 << 63, many, dtype=np.uint64)
    counts = np.maximum((3e5 / np.arange(1, many + 1)).astype(np.int64), 1)
    own = draw.normal(0, 1, (many, quality_model.WIDTH)) * counts[:, None]
    rows, signs = quality_model.table_rows(names)
    contexts = np.zeros((quality_model.TABLES * quality_model.ROWS, quality_model.WIDTH))
    held = np.zeros(len(contexts))
    for t in range(quality_model.TABLES):
        np.add.at(contexts, rows[:, t], own * signs[:, t, None])
        np.add.at(held, rows[:, t], counts)
    vectors, weights = quality_model.word_vectors(
        names, quality_model.scaled(contexts).astype(np.float32), held, float(counts.sum()))
    want = np.sign(own) * np.log1p(np.abs(own))
    want /= np.linalg.norm(want, axis=1, keepdims=True)
    alike = (vectors * want).sum(axis=1)
    # a word in hundreds of thousands may meet more frequent ones in two of its three rows, few do
    assert np.mean(alike[:200] > 0.9) >= 0.98 and np.median(alike[200:4000]) > 0.9
    assert np.all(weights <= 1 / (1 + 1000 * counts / counts.sum()) + 1e-6)


def test_tables_sent_in_parts_add_up(spark, monkeypatch):
    docs, _ = _labelled(spark, 60)
    whole = quality_model.word_tables(docs)
    column = pa.RecordBatch.from_arrays([pa.array([r.text for r in docs.collect()] * 30)], names=["text"])
    monkeypatch.setattr(quality_model, "FLUSH", 500)
    monkeypatch.setattr(quality_model, "blocks", lambda c: kernels.blocks(c, 1000))
    contexts, counts = np.zeros_like(whole[0]), np.zeros_like(whole[1])
    parts = list(quality_model._contexts(iter([column])))
    for part in parts:
        at = part.column("bucket").to_numpy()
        contexts[at] += np.array(part.column("context").to_pylist())
        counts[at] += part.column("count").to_numpy()
    assert len(parts) > 10 and np.array_equal(counts, 30 * whole[1])
    assert np.allclose(quality_model.scaled(contexts / 30), whole[0], atol=1e-6)


def test_classifier_defined_results(spark, edge_docs, edge_rows, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality_model.score(edge_docs, none).collect()} == {0.5}
    odd = spark.createDataFrame([(0, 1), (1, 0), (1, 0), (7, None), (None, 1), (14, 1), (16, 0)], "doc_id long, quality int")
    rows = quality_model.score(edge_docs, odd).collect()
    assert len(rows) == len(edge_rows) and all(0 <= r.score <= 1 for r in rows)
    assert quality_model.score(no_docs, odd).collect() == []


def test_temperature_mends_overconfidence():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(4000, 3))
    y = (draw.random(4000) < 1 / (1 + np.exp(-x[:, 0]))).astype(float)
    model = quality_model.Network(3)
    model.logits = lambda z: 5 * z[:, 0]
    model.calibrate(x, y)
    assert 4 < model.temperature < 6.2


# --- archives --------------------------------------------------------------------------------
def test_archives_round_trip(spark, tmp_path):
    rows = [(5, "http://a/1", "<p>é one</p>"), (3, "http://a/2", "<p>é one</p>"), (9, "http://a/3", None), (1, None, ""),
            (7, "http://b/\r\nX: 1", "x" * 200000), (None, "http://c", "<p>é one</p>"), (8, "u", "WARC/1.1\r\n\r\nbody")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    path = str(tmp_path / "archives")
    warc.write_archives(pages, path)
    got = {r.page_id: r for r in warc.read_archives(spark, path, payload=True).where("record_type <> 'warcinfo'").collect()}
    first = {"<p>é one</p>": 3, "": 1}
    for page, _, html in rows:
        payload = (html or "").encode()
        row = got[page]
        leader = first.get(html or "", page)
        assert row.record_type == ("response" if leader == page else "revisit")
        assert row.refers_to == (None if leader == page else leader)
        assert (row.payload_bytes, row.payload_digest) == (
            len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())
        assert bytes(row.payload) == (payload if leader == page else b"")
    # any gzip reader sees whole records
    archive = next(p for p in (tmp_path / "archives").iterdir() if p.name.endswith(".warc.gz"))
    assert gzip.decompress(archive.read_bytes()).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")


def test_small_payloads_and_empty_tables(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "aa"), (2, "u", "aa"), (3, "u", "bbbb"), (4, "u", "bbbb")],
                                  "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "a"), min_payload_bytes=3)
    rows = warc.read_archives(spark, str(tmp_path / "a")).where("record_type IN ('response', 'revisit')").collect()
    assert {r.page_id: r.refers_to for r in rows} == {1: None, 2: None, 3: None, 4: 3}
    warc.write_archives(pages.limit(0), str(tmp_path / "b"))
    assert warc.read_archives(spark, str(tmp_path / "b")).where("page_id IS NOT NULL").collect() == []


def test_unwanted_payloads_are_not_inflated():
    data = [warc.record(i, "u", "response", None, 9, "X", bytes([65 + i]) * 300000) for i in range(4)]
    broken = [bytearray(warc.member(d)) for d in data]
    for m in broken[1:3]:
        m[-300:-8] = bytes(292)                      # a damaged body shows up when it is inflated
    stream = io.BytesIO(b"".join(bytes(m) for m in broken))
    found = list(warc.records(stream, lambda h: True, with_payload=False))
    assert [h["X-Page-Id"] for h, _ in found] == list("0123")
    stream.seek(0)
    found = list(warc.records(stream, lambda h: h["X-Page-Id"] in "03", with_payload=True))
    assert [p for _, p in found] == [b"A" * 300000, b"D" * 300000]
    # archives of other writers have no lengths: records are inflated past
    plain = io.BytesIO(b"".join(gzip.compress(d) for d in data))
    assert [h["X-Page-Id"] for h, _ in warc.records(plain, lambda h: h["X-Page-Id"] > "1", False)] == ["2", "3"]


def test_filters_reach_the_reader():
    from pyspark.sql.datasource import EqualTo, GreaterThan, In

    reader = warc.WarcReader("x", ["page_id"], 1)
    left = list(reader.pushFilters([EqualTo(("record_type",), "response"), In(("page_id",), (1, 2)), GreaterThan(("page_id",), 0)]))
    assert left == [GreaterThan(("page_id",), 0)]
    assert reader._accepts({"WARC-Type": "response", "X-Page-Id": "2"})
    assert not reader._accepts({"WARC-Type": "revisit", "X-Page-Id": "2"})
    assert not reader._accepts({"WARC-Type": "response"})


def test_archive_query_covers_all_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    rows = {r.page_id: r for r in QUERIES["op8_warc"](spark, sf_dir).collect()}
    assert len(rows) == len(pages)
    for page in pages:
        digest = base64.b32encode(hashlib.sha1(page.html.encode()).digest()).decode()
        assert (rows[page.page_id].payload_bytes, rows[page.page_id].payload_digest) == (len(page.html.encode()), digest)


# --- pipeline ----------------------------------------------------------------------------------
def test_stages_keep_the_columns_and_do_their_work(spark, edge_docs, sf_dir):
    docs = edge_docs
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), docs.schema)
    # the long, repeated and near-equal texts: one of each group is left before mixing
    assert docs.count() > 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()


def test_near_copies_stage_keeps_one_of_each_group(spark, sf_dir):
    base = " ".join(f"w{i}" for i in range(200))
    other, third = " ".join(f"u{i}" for i in range(90)), " ".join(f"v{i}" for i in range(70))
    rows = [(4, base), (2, base + " more"), (9, base), (7, other), (11, ""), (None, base), (7, other), (None, third),
            (None, third), (13, base), (13, third + " and its own end")]
    docs = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], "doc_id long, text string, row int, __id int, doc string")
    kept = corpus_pipeline.near_copies(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    # one of every group, copies without an id included; of two rows of one id only the copy goes
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted(
        [("2", base + " more"), ("7", other), ("11", ""), ("13", third + " and its own end")])


def test_pipeline_on_empty_table(spark, no_docs, sf_dir):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.collect() == []

"""Line dedup, n-gram join, suffix dedup and fingerprints against brute force."""

import collections
import hashlib
import random
import re

import pytest

from lakemart.llm import fingerprints, line_dedup, ngram_join, suffix_dedup, suffix_sort
from lakemart.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- components ------------------------------------------------------------------------
def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 300), (300, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}, 300: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- n-gram join -----------------------------------------------------------------------
def _set(text):
    found = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(found[i:i + 5]) for i in range(len(found) - 4)} if len(found) >= 5 else {tuple(found)} if found else set()


def _linked(rows):
    """(number of shingles, component) of every row by comparing all pairs; rows of one id are one node."""
    sets = [(i, _set(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if None not in (i, j) and a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((top(i), top(j)))
                parent[y] = x
    return sorted((str(i), len(s), str(None if i is None else top(i))) for i, s in sets)


def _near_copies(n, seed=4):
    draw = random.Random(seed)
    rows, base = [], []
    for i in range(n):
        if i % 9 == 0:
            base = [f"w{draw.randrange(400)}" for _ in range(draw.randrange(5, 160))]
        changed = list(base)
        for _ in range(draw.randrange(0, 1 + len(base) // 12)):
            changed[draw.randrange(len(changed))] = f"v{draw.randrange(10**6)}"
        rows.append((draw.randrange(10**6), " ".join(changed[:draw.randrange(int(len(base) * 0.8), len(base) + 1)])))
    return rows


@pytest.mark.parametrize("block", [4, 2048])
def test_join_finds_all_links(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", block)   # small: large tiles meet in blocks
    rows = _near_copies(150) + [(-1, None), (-2, ""), (-3, " \n"), (-4, "one two"), (-5, "One two"), (-6, "one two three")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = ngram_join.similar_components(docs).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == _linked(rows)


def test_join_defined_results(spark, edge_docs, edge_rows, no_docs):
    got = ngram_join.similar_components(edge_docs).collect()
    expected = _linked([(r[0], r[1]) for r in edge_rows])
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == expected
    assert ngram_join.similar_components(no_docs).collect() == []


# --- suffix dedup ----------------------------------------------------------------------
def test_deep_shallow_order():
    draw = random.Random(5)
    for _ in range(150):
        base = bytes(draw.choice(b"ab") for _ in range(200))
        strings = [base[:draw.randrange(201)] + bytes(draw.choice(b"abc") for _ in range(draw.randrange(10)))
                   for _ in range(draw.randrange(1, 40))]
        order, shared = suffix_sort.sort(strings)
        assert [strings[i] for i in order] == sorted(strings) and sorted(order) == list(range(len(strings)))
        for (i, j), n in zip(zip(order, order[1:]), shared[1:]):
            a, b = strings[i], strings[j]
            assert a[:n] == b[:n] and (len(a) == n or len(b) == n or a[n] != b[n])


def _removed(rows):
    windows = collections.Counter()
    data = [(i, (t or "").encode()) for i, t in rows]
    for _, b in data:
        windows.update(b[k:k + 400] for k in range(len(b) - 399))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - 399):
            if windows[b[k:k + 400]] > 1:
                gone[k:k + 400] = b"\1" * 400
        spans = sum(gone[k] and (k == 0 or not gone[k - 1]) for k in range(len(b)))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((str(i), len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def _removal(docs, **options):
    rows = suffix_dedup.remove_repeats(docs, **options).collect()
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)


@pytest.mark.parametrize("group", [2, 2048])
def test_repeats_are_removed_to_the_byte(spark, group):
    draw = random.Random(8)
    text = lambda n: "".join(draw.choice("abcdé \n") for _ in range(n))
    passages = [text(n) for n in (380, 399, 400, 401, 650, 1500)]
    rows = [(i, text(draw.randrange(300)) + draw.choice(passages)[draw.randrange(60):] + text(draw.randrange(300)))
            for i in range(40)]
    rows += [(100, "ab" * 700), (101, "x" * 399), (102, "y" * 400), (103, "z" * 401)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert _removal(docs, group=group) == _removed(rows)


def test_repeats_defined_results(edge_docs, edge_rows, no_docs):
    assert _removal(edge_docs.select("doc_id", "text")) == _removed([(r[0], r[1]) for r in edge_rows])
    assert _removal(no_docs.select("doc_id", "text")) == []


def test_long_text_is_anchored_in_stretches(monkeypatch):
    import numpy as np

    data = np.frombuffer(random.Random(3).randbytes(6000), dtype=np.uint8)
    whole = suffix_dedup.anchors(data)
    monkeypatch.setattr(suffix_dedup, "_STRETCH", 700)
    parts = suffix_dedup.anchors(data)
    at = lambda rows: {(i, int(rows[2][k] + rows[4][k]), int(rows[0][k])) for k in range(len(rows[0]))
                       for i in range(int(rows[2][k]), int(rows[2][k] + rows[4][k] - rows[3][k]) + 1)}
    assert at(whole) == at(parts) and len({i for i, *_ in at(whole)}) == 5601


# --- fingerprints ------------------------------------------------------------------------
def test_fingerprints_follow_the_next_document(spark, edge_rows):
    rows = [(i, t) for i, t, *_ in {r[0]: r for r in edge_rows if r[0] is not None}.values()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in fingerprints.fingerprint_pairs(docs).collect()}
    assert len(got) == len(rows)
    ordered = sorted(rows, reverse=True)
    prints = {}
    for (i, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        text, after = text or "", after or ""
        half = len(text) // 2
        changed = text[:len(text) - half] + after[:half]
        row = got[i]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert row.near_next == fingerprints.likeness(fingerprints.chunks(text), fingerprints.chunks(after))
        assert row.edited_fingerprint == fingerprints.written(fingerprints.chunks(changed))
        assert 0 <= row.near_edited <= 1 and prints.setdefault(text, row.fingerprint) == row.fingerprint


def test_fingerprints_defined_results(spark, edge_docs, edge_rows, no_docs):
    assert len(fingerprints.fingerprint_pairs(edge_docs).collect()) == len(edge_rows)
    assert fingerprints.fingerprint_pairs(no_docs).collect() == []
    one = fingerprints.fingerprint_pairs(spark.createDataFrame([(3, "abc def")], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.near_next) for r in one] == [(3, 1.0)]
    assert fingerprints.likeness({}, {}) == 1.0 and fingerprints.likeness({}, {1: 2}) == 0.0


def test_chunks_survive_a_shift():
    draw = random.Random(2)
    text = "".join(draw.choice("abcdefgh ") for _ in range(6000))
    whole, moved = fingerprints.chunks(text), fingerprints.chunks("inserted words " + text)
    assert fingerprints.likeness(whole, moved) > 0.95
    assert fingerprints.likeness(whole, fingerprints.chunks(text[::-1])) < 0.05
    lengths = list(whole.values())
    assert min(lengths[:-1]) >= fingerprints.SHORTEST and max(lengths) <= fingerprints.LONGEST


# --- line dedup --------------------------------------------------------------------------
def test_recurring_templates_go_but_for_the_first(spark):
    own = lambda i: f"only document {'abcdefgh'[i]} says so, in words of its own"
    rows = [(i, f"{own(i)}\nPage {i} of 90 printed on day 2{i}\nRead more here\n\n{own(i)} twice") for i in range(6)]
    rows += [(20, "Pair of lines in two places"), (21, "Pair of lines in two places"), (22, "Page one of many others")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in line_dedup.drop_templates(docs).collect()}
    assert got[0].text == rows[0][1] and got[0].n_dropped == 0
    for i in range(1, 6):
        assert got[i].text == f"{own(i)}\n\n{own(i)} twice" and (got[i].n_lines, got[i].n_dropped) == (5, 2)
    assert [got[i].n_dropped for i in (20, 21, 22)] == [0, 0, 0]


def test_variable_words_are_generalised_and_crowded_leaves_deepen(spark, monkeypatch):
    line = "the user named {} has signed in to the service at the front door today"
    rows = [(i, line.format(f"{a}{b}")) for i, (a, b) in enumerate((a, b) for a in "abcdef" for b in "ghijkl")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.n_dropped for r in line_dedup.drop_templates(docs).collect()}
    assert got == {i: int(i > 0) for i in range(36)}
    monkeypatch.setattr(line_dedup, "CROWDED", 5)
    rows = [(i, f"same start here and {a} then {b} at last") for i, (a, b) in enumerate(
        (a, b) for a in "abcdef" for b in "ghijkl")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(line_dedup.drop_templates(docs).collect()) == 36


def _needed(line):
    return line_dedup.FEW_DOCS if len(line.split()) < line_dedup.FEW_WORDS else line_dedup.MIN_DOCS


def _fillings(n):
    return ["".join("abcdefghij"[int(d)] for d in f"{i:04d}") for i in range(n)]


def test_many_fillings_of_a_template_go_like_few(spark):
    line = "the user named {} has signed in to the service at the front door today"
    rows = [(i, line.format(name)) for i, name in enumerate(_fillings(513))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.n_dropped for r in line_dedup.drop_templates(docs).collect()}
    assert got == {i: int(i > 0) for i in range(513)}


def test_dropped_lines_do_not_depend_on_the_lines_a_task_holds(spark, monkeypatch):
    draw = random.Random(5)
    word = lambda n: draw.choice("abcdefghijklmnop"[:n]) * 3
    lines = [" ".join(["one", "same", "start"][:min(3, n)] + [word(m) for _ in range(n - 3)])
             for n, m, times in ((4, 9, 20), (5, 9, 60), (7, 4, 60), (10, 3, 150), (10, 12, 60), (14, 2, 150))
             for _ in range(times)]
    rows = [(i, "\n".join(draw.choices(lines, k=4))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    # the definition, line by line: the earliest first line of a template that a line is like
    leaders, of = [], {}
    split = [(i, k, line) for i, text in rows for k, line in enumerate(text.split("\n"))]
    for _, _, line in split:
        if line not in of:
            mine = line.split()
            of[line] = next((x for x in leaders if len(x.split()) == len(mine) and sum(
                a == b for a, b in zip(x.split(), mine)) / len(mine) >= 0.7), line)
            leaders += [line] * (of[line] == line)
    holders = collections.defaultdict(set)
    for i, _, line in split:
        holders[of[line]].add(i)
    seen, expected = set(), collections.Counter()
    for i, _, line in split:
        expected[i] += of[line] in seen and len(holders[of[line]]) >= _needed(line)
        seen.add(of[line])
    for held in (512, 40, 7):
        monkeypatch.setattr(line_dedup, "CROWDED", held)
        got = {r.doc_id: r.n_dropped for r in line_dedup.drop_templates(docs).collect()}
        assert got == dict(expected), held


def test_rows_of_different_numbers_stay(spark):
    numbers = lambda i: "\n".join(f"{2000 + i} {i}.{k} 8{k}{i} x{i}{k}" for k in range(6))
    long = lambda i: f"{i} 1 2 3 4 5 6 7 8 9"
    rows = [(i, f"{numbers(i)}\n{long(i)}\n9 9 9 total\nPage {i} of the book") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.drop_templates(docs).collect()}
    assert {i: got[i].text for i in got} == {
        i: f"{numbers(i)}\n{long(i)}" + ("\n9 9 9 total\nPage 0 of the book" if i == 0 else "") for i in range(5)}
    rows = [(i, numbers(i)) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert line_dedup.drop_templates(docs, drop_emptied=True).count() == 5


def test_lines_of_two_documents_go_from_the_second(spark):
    passage, seven = " ".join(f"word{chr(97 + i)}" for i in range(26)), "a line of seven words recurs twice"
    rows = [(i, f"{passage}\n{seven}\nonly six words in this one\n{'uvw'[i]} is alone") for i in range(2)]
    rows += [(2, f"once here and nowhere else in all texts\n{passage[:-1]}x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.drop_templates(docs).collect()}
    assert got == {0: rows[0][1], 1: "only six words in this one\nv is alone", 2: "once here and nowhere else in all texts"}


def test_line_dedup_defined_results(edge_docs, edge_rows, no_docs):
    rows = line_dedup.drop_templates(edge_docs).collect()
    assert len(rows) == len(edge_rows)
    assert set(rows[0].asDict()) == set(edge_docs.columns) | {"n_lines", "n_dropped"}
    assert {r.doc_id for r in rows if r.text is None} == {0}
    assert all(r.n_dropped <= r.n_lines for r in rows)
    assert line_dedup.drop_templates(no_docs).collect() == []

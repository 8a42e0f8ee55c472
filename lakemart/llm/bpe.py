"""Byte-pair encoding by a tokenization automaton.

The automaton reads token labels. It starts as one state with an arc for every byte;
each merge (u, v), in order, adds a gadget: behind u the arc v is cut off, and wherever
an arc u followed by v led, an arc uv leads to where v led. What remains accepts, for
every byte string, exactly one sequence of labels: its encoding. The state behind an
arc depends on the arc's label alone, so a state is kept as the cuts its label got,
on top of the state it was copied from; an arc is kept as the arc it grew from. A
transition is one look into that table, remembered per pair of labels.

Encoding walks a word once: every prefix has one accepted sequence, so from each
position only the arcs whose labels match the bytes are tried and each position is
entered once. Decoding emits the labels of the arcs.

Texts are cut at added tokens, then pre-split by the byte-level pattern. Words are
encoded once per worker while a bounded table remembers them.

Defined results: a null text is empty; an empty text has no tokens; tokens unknown to
the vocabulary raise on decoding; a vocabulary with two merges to one token, merges of
unknown parts, or added tokens with special matching rules is refused.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: how byte-level vocabularies pre-split a text.
SPLIT = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
REMEMBERED_WORDS = 300_000
REMEMBERED_ARCS = 2_000_000
START = -1                     # the state before the first arc: no arc is cut off
TOKEN = 256                    # key of a trie node's token


def byte_letters() -> dict[str, int]:
    """Byte of every letter of a byte-level vocabulary: printable bytes stand for themselves, others follow 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    letters.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))})
    return letters


class Automaton:
    def __init__(self, description: str):
        parts = json.loads(description)
        model = parts["model"]
        splitter = parts["pre_tokenizer"] or {}
        if splitter.get("type") != "ByteLevel" or splitter.get("add_prefix_space") or parts["normalizer"]:
            raise ValueError("only byte-level vocabularies without normalizer or prefix space are supported")
        letters = byte_letters()
        self.labels: dict[int, bytes] = {
            i: bytes([letters[c] for c in token]) for token, i in model["vocab"].items()}
        self.added: dict[str, int] = {}
        for token in parts.get("added_tokens", []):
            if token["single_word"] or token["lstrip"] or token["rstrip"] or token["normalized"]:
                raise ValueError(f"added token with matching rules: {token['content']}")
            self.added[token["content"]] = token["id"]
            self.labels[token["id"]] = token["content"].encode("utf-8")
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) \
            if self.added else None

        ids = model["vocab"]
        n = max(self.labels) + 1
        self.cuts: list[dict[int, int]] = [{} for _ in range(n)]   # label -> {arc cut off behind it: step}
        self.copied: list[tuple[int, int] | None] = [None] * n     # label -> (label whose state was copied, step)
        self.grown: list[tuple[int, int] | None] = [None] * n      # label -> (arc it grew from, step)
        self.arcs: dict[int, bool] = {}
        self.width = n
        live = {ids[letter] for letter in letters if letter in ids}
        for step, pair in enumerate(model["merges"]):
            u, v = pair.split(" ") if isinstance(pair, str) else pair
            self._gadget(step, ids[u], ids[v], ids[u + v], live)
        self.arcs.clear()
        self.trie: dict = {}
        for label in live:
            node = self.trie
            for byte in self.labels[label]:
                node = node.setdefault(byte, {})
            node[TOKEN] = label

    def _gadget(self, step: int, u: int, v: int, joined: int, live: set[int]) -> None:
        if u not in live or v not in live or not self._walk(u, v):
            return                       # u is never followed by v: the merge cannot happen
        if joined in live:
            raise ValueError("two merges make one token")
        self.copied[joined] = (v, step)
        self.grown[joined] = (u, step)
        self.cuts[u][v] = step
        live.add(joined)

    def _walk(self, state: int, label: int) -> bool:
        """Whether the state behind ``state`` has the arc ``label``: no cut reached the state's copies
        before they were made and an arc that ``label`` grew from before it grew."""
        until = self.width * 2
        while True:
            cuts = self.cuts[state]
            if cuts:
                arc, born = label, self.width * 2
                while True:
                    at = cuts.get(arc)
                    if at is not None and at < until and at <= born:
                        return False
                    if self.grown[arc] is None:
                        break
                    arc, born = self.grown[arc]
            if self.copied[state] is None:
                return True
            state, until = self.copied[state]

    def goes(self, state: int, label: int) -> bool:
        if state == START:
            return True
        key = state * self.width + label
        known = self.arcs.get(key)
        if known is None:
            if len(self.arcs) >= REMEMBERED_ARCS:
                self.arcs.clear()
            known = self.arcs[key] = self._walk(state, label)
        return known

    def encode_word(self, word: bytes) -> list[int]:
        n = len(word)
        last: list[int | None] = [None] * (n + 1)     # the label that leads to each position
        last[0] = START
        for at in range(n):
            state, node, to = last[at], self.trie, at
            while to < n:
                node = node.get(word[to])
                if node is None:
                    break
                to += 1
                label = node.get(TOKEN)
                if label is not None and last[to] is None and self.goes(state, label):
                    last[to] = label
        out, at = [], n
        while at:
            label = last[at]
            out.append(label)
            at -= len(self.labels[label])
        return out[::-1]

    def pieces(self, text: str) -> Iterator[tuple[str, int | None]]:
        """The words of a text, and added tokens with their id."""
        at = 0
        if self.cut is not None:
            for hit in self.cut.finditer(text):
                for word in SPLIT.findall(text[at:hit.start()]):
                    yield word, None
                yield hit.group(), self.added[hit.group()]
                at = hit.end()
        for word in SPLIT.findall(text[at:] if at else text):
            yield word, None

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for word, token in self.pieces(text):
            if token is None:
                out += self.encode_word(word.encode("utf-8"))
            else:
                out.append(token)
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.labels[i] for i in ids]).decode("utf-8", errors="replace")


class Worker:
    """An automaton with its table of known words: (written ids, their number, emitted bytes)."""

    def __init__(self, description: str):
        self.machine = Automaton(description)
        self.known: dict[str, tuple[str, int, bytes]] = {}

    def _learn(self, word: str, token: int | None) -> tuple[str, int, bytes]:
        ids = self.machine.encode_word(word.encode("utf-8")) if token is None else [token]
        entry = (",".join(map(str, ids)), len(ids), b"".join([self.machine.labels[i] for i in ids]))
        if len(self.known) >= REMEMBERED_WORDS:
            self.known.clear()
        if token is None and len(word) <= 64:
            self.known[word] = entry
        return entry

    def row(self, text: str) -> tuple[int, str, bytes]:
        """Number of tokens, ids joined by commas, bytes of the decoded text."""
        machine, known = self.machine, self.known
        found = SPLIT.findall(text) if not any(a in text for a in machine.added) else None
        if found is not None:
            entries = [known.get(w) or self._learn(w, None) for w in found]
        else:
            entries = [self._learn(w, t) if t is not None else known.get(w) or self._learn(w, None)
                       for w, t in machine.pieces(text)]
        return sum([e[1] for e in entries]), ",".join([e[0] for e in entries]), b"".join([e[2] for e in entries])


_workers: dict[str, Worker] = {}


def worker(description: str) -> Worker:
    """The process's own, made once for a vocabulary."""
    name = hashlib.sha256(description.encode("utf-8")).hexdigest()
    if name not in _workers:
        _workers[name] = Worker(description)
    return _workers[name]


def encode_decode(docs: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row; with ``keep_ids`` also the ids themselves.

    The vocabulary file is read once and sent to the workers (a few MB, whatever the input).
    """
    with open(path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = worker(shared.value)
        for batch in batches:
            counts, digests, decoded, ids = [], [], [], []
            for text in batch.column("text"):
                n, written, emitted = machine.row(text.as_py() or "")
                counts.append(n)
                digests.append(hashlib.sha256(written.encode("ascii")).hexdigest())
                whole = emitted.decode("utf-8", errors="replace").encode("utf-8")
                decoded.append(hashlib.sha256(whole).hexdigest())
                if keep_ids:
                    ids.append([int(i) for i in written.split(",")] if n else [])
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests, pa.string()),
                       pa.array(decoded, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id"), "text").mapInArrow(rows, schema + (", ids array<int>" if keep_ids else ""))

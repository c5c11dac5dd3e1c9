"""Benchmark decontamination.

All windows of a benchmark's items go into one Aho-Corasick automaton. Words are the
letters of its alphabet: each distinct word of the benchmark is one character, every other
word is character 0, so a document is a string with one character for each of its words,
scanned once, and a match's position is the index of a word, whose place in the original
text is known.

The benchmark is read in blocks of ``max_windows`` windows (usually there is one), so that
an automaton and the broadcast of it stay bounded; each block scans all documents, and a row
carries the hits of the blocks before along, so no rows are ever taken together.

Defined results: null texts have no words; an item without words has no window, one with
fewer than ``window`` words is one window; equal items are all reported; rows of documents
are judged each by itself, also if they are equal; very long texts are scanned whole; other
columns are not looked at by ``find``, and kept by ``remove``, whatever their names; an empty
table or benchmark gives no rows and no hits.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import ALNUM, Text, in_batches, owners, pieces
from .staging import stage

WINDOW = 10
MAX_WINDOWS = 1 << 20
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_SKIP = 0xD800  # letters from here on are moved past the surrogates


class Automaton:
    """``items``: id and lower-cased words (bytes) of each."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.ids = [i for i, _ in items]
        vocabulary = sorted({w for _, words in items for w in words})
        data = np.frombuffer(b"".join(vocabulary), np.uint8)
        ends = np.cumsum([len(w) for w in vocabulary], dtype=np.int64)
        starts = ends - np.array([len(w) for w in vocabulary], np.int64)
        t = Text(data, np.append(np.zeros(1, np.int64), ends))
        hashes = t.hashes(t.lower_sums, starts, ends) if vocabulary else np.zeros(0, np.uint64)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        letters = np.arange(1, len(vocabulary) + 1, dtype=np.uint32)
        letters[letters >= _SKIP] += 0x800
        self.letters = letters[order]
        letter = {w: chr(x) for w, x in zip(vocabulary, letters.tolist(), strict=True)}
        self.machine, self.of = ahocorasick.Automaton(), []
        for at, (_, words) in enumerate(items):
            s = "".join(letter[w] for w in words)
            for i in range(max(len(s) - window, 0) + 1 if s else 0):
                w = s[i : i + window]
                k = self.machine.get(w, None)
                if k is None:
                    k = len(self.of)
                    self.machine.add_word(w, k)
                    self.of.append((len(w), []))
                if not self.of[k][1] or self.of[k][1][-1] != at:
                    self.of[k][1].append(at)
        if self.of:
            self.machine.make_automaton()

    def hits(self, t: Text) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and first word of each text's words; per match its first word and
        one past its last, and the window's number."""
        starts, ends, first = t.spans(ALNUM[t.data])
        none = np.zeros((0, 3), np.int64)
        if not len(starts) or not self.of:
            return starts, ends, first, none
        h = t.hashes(t.lower_sums, starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        letters = np.where(self.hashes[at] == h, self.letters[at], 0).astype("<u4")
        # one character between documents, so that no match crosses
        place = np.arange(len(starts)) + owners(first)
        string = np.zeros(len(starts) + t.n, "<u4")
        string[place] = letters
        back = np.zeros(len(string), np.int64)
        back[place] = np.arange(len(starts))
        found = [(back[e], k) for e, k in self.machine.iter(string.tobytes().decode("utf-32-le"))]
        return starts, ends, first, np.array([(e + 1 - self.of[k][0], e + 1, k) for e, k in found], np.int64).reshape(-1, 3)


def _blocks(benchmark: DataFrame, key: str, text: str, window: int, most: int) -> Iterator[list]:
    """Items of ``most`` words together, and no more. A longer item is cut into parts of
    ``most``, and each has besides the words that the windows beginning in it need."""
    block, n = [], 0
    for r in benchmark.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t")).toLocalIterator():
        words = _WORD.findall((r["t"] or "").encode().lower())
        for i in range(0, len(words) if r["k"] is not None else 0, most):
            part = words[i : i + most + window - 1]
            if i and len(part) < window:
                continue
            if block and n + len(part) > most:
                yield block
                block, n = [], 0
            block.append((r["k"], part))
            n += len(part)
    if block:
        yield block


def _digest(ids: set[str]) -> str:
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()


def _united(spans: list[dict]) -> list[dict]:
    out: list[dict] = []
    for s in sorted(spans, key=lambda s: s["word"]):
        if out and s["word"] <= out[-1]["end_word"]:
            out[-1] = out[-1] | {x: max(out[-1][x], s[x]) for x in ("end_word", "end_byte")}
        else:
            out.append(s)
    return out


def _scan(docs: DataFrame, key: str, text: str, shared, last: bool) -> DataFrame:
    """Per row: n_words, the spans hit as word and byte offsets, and the items' ids, united
    with those of the scan before, if ``docs`` are its rows. The last scan drops the text."""
    before = [c for c in docs.columns if c not in (key, text)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = shared.value
        for b, t in (x for whole in batches for x in pieces(whole, 1)):
            starts, ends, first, found = a.hits(t)
            edge = np.zeros(len(starts) + 1, np.int64)
            np.add.at(edge, found[:, 0], 1)
            np.add.at(edge, found[:, 1], -1)
            hit = np.cumsum(edge)[:-1] > 0
            of, doc = owners(first), {}
            for e, k in found[:, 1:].tolist():
                doc.setdefault(int(of[e - 1]), set()).update(a.of[k][1])
            spans: list[list] = [[] for _ in range(t.n)]
            ids: list[list] = [[] for _ in range(t.n)]
            for i, items in doc.items():
                mine = np.concatenate([[False], hit[first[i] : first[i + 1]], [False]])
                turn = np.flatnonzero(mine[1:] != mine[:-1]).reshape(-1, 2)
                spans[i] = [{"word": int(x), "end_word": int(y), "byte": int(starts[first[i] + x] - t.offs[i]), "end_byte": int(ends[first[i] + y - 1] - t.offs[i])} for x, y in turn]
                ids[i] = sorted({a.ids[k] for k in items})
            if before:
                spans = [_united(x + y) if x and y else x or y for x, y in zip(b.column("spans").to_pylist(), spans, strict=True)]
                ids = [sorted({*x, *y}) if x and y else x or y for x, y in zip(b.column("item_ids").to_pylist(), ids, strict=True)]
            made = [pa.array(np.diff(first), pa.int64()), pa.array(spans, SPANS), pa.array(ids, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([b.column(0), *([] if last else [b.column(1)]), *made], names)

    names = ["key", *([] if last else ["text"]), "n_words", "spans", "item_ids"]
    kind = docs.schema[key].dataType.simpleString()
    carried = "" if last else "text string, "
    found = docs.select(key, text, *before).mapInArrow(run, f"key {kind}, {carried}n_words long, spans array<struct<word:long,end_word:long,byte:long,end_byte:long>>, item_ids array<string>")
    return found.withColumnsRenamed({"key": key} if last else {"key": key, "text": text})


SPANS = pa.list_(pa.struct([(x, pa.int64()) for x in ("word", "end_word", "byte", "end_byte")]))


def _automata(docs: DataFrame, benchmark: DataFrame, item: str, item_text: str, window: int, most: int) -> Iterator[tuple[object, bool]]:
    """One broadcast automaton after the other, and whether it is the last."""
    share = docs.sparkSession.sparkContext.broadcast
    ahead: list = []
    for block in _blocks(benchmark, item, item_text, window, most):
        if ahead:
            yield share(Automaton(ahead, window)), False
        ahead = block
    yield share(Automaton(ahead, window)), True


def find(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """Of every row: key, n_words, n_hit, n_items, spans, item_ids, items_sha256,
    contaminated. ``spans`` are the maximal runs of hit words with their byte offsets in
    the original text."""
    found = in_batches(docs.select(key, text))
    for shared, last in _automata(docs, benchmark, item, item_text, window, max_windows):
        found = _scan(found, key, text, shared, last)
        if not last:  # so that a task holds one automaton
            found = stage(found, "scanned")
            shared.destroy()
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end_word"] - s["word"])
    return found.select(key, "n_words", hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"), "spans", "item_ids", F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def remove(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """The rows of ``docs``, unchanged, whose text holds no window of the benchmark."""
    at = docs.columns.index(text)
    for shared, last in _automata(docs, benchmark, item, item_text, window, max_windows):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            a = shared.value
            for b in batches:
                for rows, t in pieces(b, at):
                    clean = np.ones(t.n, bool)
                    _, _, first, found = a.hits(t)
                    clean[owners(first)[found[:, 1] - 1]] = False
                    yield rows.filter(pa.array(clean))

        docs = in_batches(docs).mapInArrow(run, docs.schema)
        if not last:  # so that a task holds one automaton
            docs = stage(docs, "scanned")
            shared.destroy()
    return docs

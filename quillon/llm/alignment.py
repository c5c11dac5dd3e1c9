"""Alignment of two tokenizers' tokens, and how often each pair of ids is aligned.

Both tokenizers cut the same bytes. The ends of either's tokens cut a text into segments, and
each segment is the overlap of one token of A with one of B: a link. Where tokens of both end,
a group ends. A pair of ids is one int64 (A's id in the upper half).

Counts are of documents: a document sends each of its pairs once, a partition sums them with
``np.unique``, and the partial counts are sorted globally by range partition, whose tasks add
up runs of equal pairs and write them to files of sorted keys and of counts, the shards. To
look counts up, a task maps the shards into memory and searches them for its own sorted pairs,
so what it holds does not grow with the table.

Shards lie in the folder of ``spark.checkpoint.dir``, written and opened by Arrow's file
systems. A mounted folder is mapped; from another store a shard is read when it is searched.
Each attempt of a task writes files of its own, and only those of the attempt that ended well
are known to what follows.

Defined results: texts that are null or empty, or whose bytes are not exactly those of the
tokens of both (U+2581 in a text), have no tokens, links or groups; very long texts are handled
whole, in memory in proportion to the text; repeated rows count each; an empty table gives no
rows; of the other columns, ``keep`` are kept.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .piece_bpe import SPACE, piece_encoder, spaced
from .scan import Text, in_batches, owners, slices
from .staging import scratch, stage
from .tokens import byte_letters, encoder

TEXT_LIMIT = 1 << 21
HELD = 1 << 22  # pairs that a task holds before it sums or sends them
COLUMNS = "n_a long, n_b long, n_groups long, n_links long, groups string, pairs binary, times binary"


def _byte_level(path: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all entries of a byte-level vocabulary, and where each begins."""
    back = {ord(c): b for b, c in byte_letters().items()}
    own = encoder(path, plain=True).tokenizer
    each = [bytes(back[ord(c)] for c in own.id_to_token(i) or "" if ord(c) in back) for i in range(own.get_vocab_size())]
    return np.frombuffer(b"".join(each), np.uint8), np.cumsum([0, *map(len, each)])


_tables: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def _table(path: str) -> tuple[np.ndarray, np.ndarray]:
    if path not in _tables:
        _tables[path] = piece_encoder(path).spelt if path.endswith(".model") else _byte_level(path)
    return _tables[path]


def ids_of(path: str) -> int:
    """The size of a vocabulary."""
    return len(_table(path)[1]) - 1


def _tokens(t: Text, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, each text's first, each token's end, and which texts its tokens spell exactly."""
    ids, at = (piece_encoder(path) if path.endswith(".model") else encoder(path, plain=True)).encode(t)
    spelt, begin = _table(path)
    size = (begin[1:] - begin[:-1])[ids]
    ends = np.cumsum(size)
    before = np.append(0, ends)
    made = spelt[np.arange(before[-1]) + np.repeat(begin[:-1][ids] - before[:-1], size)]
    exact = np.diff(before[at]) == np.diff(t.offs)
    if exact.all():
        if not np.array_equal(made, t.data):
            exact = np.array([np.array_equal(made[a:b], t.data[a:b]) for a, b in zip(t.offs, t.offs[1:], strict=False)], bool)
    else:
        exact = np.array([np.array_equal(made[before[at[i]] : before[at[i + 1]]], t.data[t.offs[i] : t.offs[i + 1]]) for i in range(t.n)], bool)
    return ids.astype(np.int64), at, ends, exact


def _without(t: Text, empty: np.ndarray) -> Text:
    """The texts, some of them empty."""
    size = np.where(empty, 0, np.diff(t.offs))
    return Text(t.data[np.repeat(~empty, np.diff(t.offs))], np.append(0, np.cumsum(size)))


def _written(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, n_groups: int, docs: np.ndarray) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` for each document; ``docs`` has each one's first group."""
    many_a, many_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
    first_a = np.cumsum(many_a + many_b) - many_a - many_b
    own = np.arange(len(a)) - np.repeat(np.cumsum(many_a) - many_a, many_a)
    ids, mark = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
    ids[first_a[group_a] + own] = a
    ids[first_a[group_b] + many_a[group_b] + np.arange(len(b)) - np.repeat(np.cumsum(many_b) - many_b, many_b)] = b
    mark[first_a + many_a - 1] = ord("|")
    mark[first_a + many_a + many_b - 1] = ord(";")
    wide = len(str(max(ids.max(initial=0), 1)))
    cells = np.empty((len(ids), wide + 1), np.uint8)
    for k in range(wide):
        cells[:, wide - 1 - k] = 48 + ids // 10**k % 10
    cells[:, wide] = mark
    shown = np.ones(cells.shape, bool)
    for k in range(1, wide):
        shown[:, wide - 1 - k] = ids >= 10**k
    flat, ends = cells[shown].tobytes().decode(), np.append(0, np.cumsum(shown.sum(1)))
    at = ends[np.append(first_a, len(ids))[docs]].tolist()
    return [flat[x : y - 1] if y > x else "" for x, y in zip(at, at[1:], strict=False)]


def _aligned(t: Text, a: str, b: str) -> Iterator[tuple[int, int, int, int, str, bytes, bytes]]:
    """A row of COLUMNS for each text, whose spaces in front are there already."""
    while True:
        (ids_a, at_a, end_a, ok_a), (ids_b, at_b, end_b, ok_b) = _tokens(t, a), _tokens(t, b)
        if (ok_a & ok_b).all():
            break
        t = _without(t, ~(ok_a & ok_b))
    cuts, offs = np.union1d(end_a, end_b), t.offs
    of_a, of_b = np.searchsorted(end_a, cuts), np.searchsorted(end_b, cuts)
    group_ends = end_a[np.isin(end_a, end_b, assume_unique=True)]
    first_link, first_group = np.searchsorted(cuts, offs, "right"), np.searchsorted(group_ends, offs, "right")
    groups = _written(ids_a, ids_b, np.searchsorted(group_ends, end_a), np.searchsorted(group_ends, end_b), len(group_ends), first_group)
    both = ids_a[of_a] << 32 | ids_b[of_b]
    pairs, code = np.unique(both, return_inverse=True)
    found, times = np.unique(owners(first_link) * np.int64(len(pairs)) + code, return_counts=True)
    doc, code = np.divmod(found, max(len(pairs), 1))
    keys, times, first = pairs[code].astype("<i8"), times.astype("<u4"), np.searchsorted(doc, np.arange(t.n + 1))
    for i in range(t.n):
        x, y = first[i], first[i + 1]
        yield int(at_a[i + 1] - at_a[i]), int(at_b[i + 1] - at_b[i]), int(first_group[i + 1] - first_group[i]), int(first_link[i + 1] - first_link[i]), groups[i], keys[x:y].tobytes(), times[x:y].tobytes()


def align(docs: DataFrame, a: str, b: str, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` and COLUMNS: numbers of tokens, groups and links, the groups as text, and the
    pairs (little-endian int64, ascending) with the number of their links (uint32).

    ``a`` is a byte-level vocabulary, whose special tokens' strings are plain text here, ``b``
    a merge-type piece vocabulary. Texts get a space in front."""
    wide = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            column = rows.column(wide)
            column = pc.if_else(pc.match_substring(pc.fill_null(column, ""), SPACE), "", column)
            for i, j, t in slices(column, TEXT_LIMIT):
                out = list(zip(*_aligned(spaced(t), a, b), strict=True))
                kinds = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.binary()]
                made = [pa.array(x, k) for x, k in zip(out, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*rows.slice(i, j - i).columns[:wide], *made], names)

    kept = docs.select(*keep, text).schema.fields[:wide]
    names = [f"kept_{i}" for i in range(wide)] + [x.split()[0] for x in COLUMNS.split(", ")]
    schema = ", ".join([f"kept_{i} {f.dataType.simpleString()}" for i, f in enumerate(kept)] + [COLUMNS])
    out = in_batches(docs.select(*[F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)], F.col(text).alias("text"))).mapInArrow(run, schema)
    return out.withColumnsRenamed({f"kept_{i}": c for i, c in enumerate(keep)})


@dataclass(frozen=True)
class Shards:
    """The count table: files of ascending pairs and of their counts, the first pair of each,
    and the highest count of each id of A. Bounded by the number of files and the vocabulary."""

    files: tuple[tuple[str, str], ...]
    first: np.ndarray
    highest: np.ndarray


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    n = np.zeros(len(keys), np.int64)
    np.add.at(n, where, np.concatenate([x for _, x in parts]))
    return keys, n


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """pair and n of column ``pairs``, summed as far as HELD goes."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def out() -> pa.RecordBatch:
        keys, n = held[0]
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["pair", "n"])

    for b in batches:
        found = [np.frombuffer(x, "<i8") for x in b.column(0).to_pylist()]
        held.append(np.unique(np.concatenate([*found, np.zeros(0, np.int64)]), return_counts=True))
        if sum(len(k) for k, _ in held) > HELD:
            held = [_summed(held)]
            if len(held[0][0]) > HELD // 2:
                yield out()
                held = []
    if held:
        held = [_summed(held)]
        yield out()


def _run_lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sums of the runs of equal pairs in rows that are sorted; the last run waits for more."""
    keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for b in batches:
        keys, n = np.append(keys, b.column(0).to_numpy()), np.append(n, b.column(1).to_numpy())
        begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        sums = np.add.reduceat(n, begin) if len(keys) else n
        keys, n = keys[begin], sums
        yield keys[:-1], n[:-1]
        keys, n = keys[-1:], n[-1:]
    yield keys, n


def count_pairs(aligned: DataFrame, ids: int) -> Shards:
    """How many rows hold each pair. ``ids``: of A's vocabulary."""
    spark = aligned.sparkSession
    folder = scratch(spark, "pair-counts")
    partial = stage(aligned.select("pairs").mapInArrow(_partial, "pair long, n long"), "pair-partials")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path)
        names = [f"{uuid.uuid4().hex}.{x}" for x in ("pairs", "counts")]
        first, rows, highest = 0, 0, np.zeros(ids, np.int64)
        with store.open_output_stream(f"{path}/{names[0]}") as to_keys, store.open_output_stream(f"{path}/{names[1]}") as to_counts:
            for keys, n in _run_lengths(batches):
                if len(keys):
                    first = int(keys[0]) if not rows else first
                    rows += len(keys)
                    to_keys.write(keys.astype("<i8").tobytes())
                    to_counts.write(n.astype("<i8").tobytes())
                    np.maximum.at(highest, keys >> 32, n)
        own = np.flatnonzero(highest)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([names]), pa.array([own], pa.list_(pa.int64())), pa.array([highest[own]], pa.list_(pa.int64()))], ["first", "files", "ids", "highest"])

    sorted_runs = partial.repartitionByRange("pair").sortWithinPartitions("pair")
    written = stage(sorted_runs.mapInArrow(write, "first long, files array<string>, ids array<long>, highest array<long>"), "pair-shards")
    shards = written.select("first", "files").orderBy("first").collect()  # a row a shard
    top = written.select(F.explode(F.arrays_zip("ids", "highest")).alias("x")).groupBy("x.ids").agg(F.max("x.highest").alias("highest")).collect()  # of the vocabulary at most
    highest = np.zeros(ids, np.int64)
    highest[[r["ids"] for r in top]] = [r["highest"] for r in top]
    return Shards(tuple((f"{folder}/{r['files'][0]}", f"{folder}/{r['files'][1]}") for r in shards), np.array([r["first"] for r in shards], np.int64), highest)


def mapped(uri: str) -> np.ndarray:
    """The numbers in a file: mapped if it lies in a mounted folder, else read."""
    store, path = fs.FileSystem.from_uri(uri)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, "<i8", "r")
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read(), "<i8")


def counts(shards: Shards, pairs: np.ndarray) -> np.ndarray:
    """The counts of pairs that are in the table, in ascending order."""
    out = np.zeros(len(pairs), np.int64)
    cuts = np.append(np.searchsorted(pairs, shards.first), len(pairs))
    for (keys, n), x, y in zip(shards.files, cuts, cuts[1:], strict=False):
        if y > x:
            out[x:y] = mapped(n)[np.searchsorted(mapped(keys), pairs[x:y])]
    return out


def look_up(aligned: DataFrame, shards: Shards) -> DataFrame:
    """``aligned`` without its pairs, with ``count_sum`` (of the counts of its links' pairs)
    and ``n_best`` (links whose pair has the highest count of its id of A)."""
    shared = aligned.sparkSession.sparkContext.broadcast(shards)
    stay = [c for c in aligned.columns if c not in ("pairs", "times")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for b in batches:
            found = [np.frombuffer(x, "<i8") for x in b.column("pairs").to_pylist()]
            times = np.frombuffer(b"".join(b.column("times").to_pylist()), "<u4").astype(np.int64)
            pairs, code = np.unique(np.concatenate([*found, np.zeros(0, np.int64)]), return_inverse=True)
            n = counts(table, pairs)
            best = n == table.highest[pairs >> 32]
            at = np.append(0, np.cumsum([len(x) for x in found])).astype(np.int64)
            sums = [np.append(0, np.cumsum(times * x[code]))[at] for x in (n, best)]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in stay], *[pa.array(np.diff(x).astype(np.int64)) for x in sums]], names)

    names = [*stay, "count_sum", "n_best"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in aligned.schema if f.name in stay) + ", count_sum long, n_best long"
    return in_batches(aligned).mapInArrow(run, schema)

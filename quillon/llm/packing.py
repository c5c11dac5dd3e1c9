"""Best-fit packing of tokenised documents into sequences.

Lengths are whole numbers up to the capacity, so the packing of any number of pieces is
decided on the histogram of their lengths (``capacity`` rows): pieces above a third of the
capacity go at most two to a sequence and are paired greedily, the longest first, each
with the longest partner that fits; the others then go, longest first, where they leave the
least room. All pieces of one length and all sequences with one gap are handled at once,
so the plan is that of the piece-by-piece algorithm in time that does not depend on their
number. A piece finds its place by its rank among the pieces of its length.

Pieces are numbered where they are made: each carries its part (the task that wrote it) and
its number among the part's pieces of its length. Its rank is that number and the pieces of
its length in the parts before, which a table of (length, part) counts tells. That table goes
to all tasks up to ``SMALL`` rows and is joined by shuffle beyond, with the same result; the
pieces and their ids are not sorted, so no length or document makes a large task. Which of
the pieces of one length goes where depends on how the documents lie in files.

Defined results: null and empty texts are one piece with the end id only; rows are packed
each by itself, also if they are equal; an empty table gives no pieces; other columns of the
documents are not looked at.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scan import in_batches
from .scan import pieces as slices_of
from .staging import stage
from .tokens import TEXT_LIMIT, encoded

CAPACITY, END = 4096, 1
SMALL = 1 << 16  # rows of counts that every task may hold: some 12 MB


def pieces(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END, with_ids: bool = True) -> DataFrame:
    """Of each piece: key, piece, start, length, ids_crc32, its part and number (``nth``) among
    the part's pieces of its length, and ids if they are asked for. To be stored before use:
    parts are those of the run that made them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for b in (rows for whole in batches for rows, _ in slices_of(whole, 1, TEXT_LIMIT)):
            row, piece, start, length, crc, nth, ids = [], [], [], [], [], [], []
            for i, x in encoded(b.column(1), tokenizer, end):
                for p, s in enumerate(range(0, len(x), capacity)):
                    cut = x[s : s + capacity]
                    row.append(i)
                    piece.append(p)
                    start.append(s)
                    length.append(len(cut))
                    crc.append(zlib.crc32(cut.tobytes()))
                    nth.append(seen[len(cut)])
                    seen[len(cut)] += 1
                    if with_ids:
                        ids.append(cut.astype(np.int32))
            columns = [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([part] * len(row), pa.int64()), pa.array(nth, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, *([pa.array(ids, pa.list_(pa.int32()))] if with_ids else [])], ["key", "piece", "start", "length", "ids_crc32", "part", "nth", *(["ids"] if with_ids else [])])

    kind = docs.schema[key].dataType.simpleString()
    return in_batches(docs.select(key, text)).mapInArrow(run, f"key {kind}, piece int, start long, length long, ids_crc32 long, part long, nth long" + ", ids array<int>" * with_ids).withColumnRenamed("key", key)


@dataclass(frozen=True)
class Plan:
    """A row tells of ``count`` pieces of one length, from ``rank`` on, that go ``each`` to
    a sequence, from sequence ``first`` on, at ``offset`` and after."""

    length: np.ndarray
    rank: np.ndarray
    each: np.ndarray
    first: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted((self.length << 40) | self.rank, (length << 40) | rank, "right") - 1
        beyond = rank - self.rank[at]
        return self.first[at] + beyond // self.each[at], self.offset[at] + beyond % self.each[at] * length


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    left, rows, used = dict(histogram), [], 0
    rank = dict.fromkeys(histogram, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: runs of sequences (first, count)
    order: list[int] = []  # the gaps, ascending

    def put(length: int, each: int, first: int, count: int, offset: int) -> None:
        rows.append((length, rank[length], each, first, offset))
        rank[length] += each * count
        left[length] -= each * count

    def leave(gap: int, first: int, count: int) -> None:
        if gap:
            if gap not in gaps:
                gaps[gap] = []
                insort(order, gap)
            gaps[gap].append((first, count))

    large = sorted(x for x in histogram if 3 * x > capacity)
    for a in reversed(large):
        while left[a]:
            i = bisect_left(large, min(a, capacity - a) + 1) - 1
            while i >= 0 and left[large[i]] < (2 if large[i] == a else 1):
                i -= 1
            if i < 0:
                first, n = used, left[a]
                put(a, 1, first, n, 0)
                leave(capacity - a, first, n)
            else:
                b = large[i]
                first, n = used, left[a] // 2 if a == b else min(left[a], left[b])
                if a == b:
                    put(a, 2, first, n, 0)
                else:
                    put(a, 1, first, n, 0)
                    put(b, 1, first, n, a)
                leave(capacity - a - b, first, n)
            used += n

    for x in sorted((x for x in histogram if 3 * x <= capacity), reverse=True):
        while left[x]:
            i = bisect_left(order, x)
            if i == len(order):
                each = min(capacity // x, left[x])
                first, n, gap = used, left[x] // each, capacity
                used += n
            else:
                gap = order[i]
                first, have = gaps[gap].pop()
                each = min(gap // x, left[x])
                n = min(have, left[x] // each)
                if have > n:
                    gaps[gap].append((first + n, have - n))
                elif not gaps[gap]:
                    del gaps[gap], order[i]
            put(x, each, first, n, capacity - gap)
            leave(gap - each * x, first, n)
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 5).T
    return Plan(*columns, used)


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (a stored table of ``pieces``) with sequence_id and offset for part and nth."""
    spark, names = parts.sparkSession, [c for c in parts.columns if c not in ("part", "nth")]
    counts = stage(parts.groupBy("length", "part").agg(F.count("*").alias("n")), "counts")
    lengths = counts.groupBy("length").agg(F.sum("n").alias("n"), F.count("*").alias("rows")).collect()  # `capacity` rows at most
    shared = spark.sparkContext.broadcast(plan({r["length"]: r["n"] for r in lengths}, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = counts.select("length", "part", (F.sum("n").over(before) - F.col("n")).alias("ahead"))
    ahead = F.broadcast(ahead) if sum(r["rows"] for r in lengths) <= SMALL else ahead.hint("merge")
    ranked = parts.join(ahead, ["length", "part"]).select(*names, (F.col("nth") + F.col("ahead")).alias("rank"))
    at = names.index("length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s, o = shared.value.place(b.column(at).to_numpy(), b.column(len(names)).to_numpy())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(s, pa.int64()), pa.array(o, pa.int64())], [*names, "sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.select(names).schema)
    return ranked.mapInArrow(run, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END, with_ids: bool = True) -> DataFrame:
    return pack(stage(pieces(docs, tokenizer, key, text, capacity, end, with_ids), "pieces"), capacity)

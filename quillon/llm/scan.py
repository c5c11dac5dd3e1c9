"""Vectorised scanning of UTF-8 text columns.

An Arrow string column is one byte buffer with offsets. The functions here find
words and lines and give them 64-bit hashes with numpy over that buffer, so that no
Python object is made for a word. Memory is bounded by ``LIMIT`` bytes of text (or
one document, if that is longer) and not by the batch or partition.
"""

from __future__ import annotations

import ctypes
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

LIMIT = 1 << 19
BATCH = 1 << 22  # bytes of rows that go to a Python worker at a time

_U = np.uint64
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
LEAD = (np.arange(256) & 0xC0) != 0x80  # the first byte of a code point

_BASE = 0x9E3779B97F4A7C13  # odd, 3 modulo 8
_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, np.int64).astype(_U) * _U(2) + _U(1)
_powers = [np.ones(1, _U), np.ones(1, _U)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words in which every input bit reaches every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        n = max(n, LIMIT + 1)
        for i, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            p = np.full(n, base, _U)
            p[0] = 1
            _powers[i] = np.cumprod(p, dtype=_U)
    return _powers


class Text:
    """Some documents: ``data`` holds their bytes, document i is data[offs[i]:offs[i+1]]."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.data, self.offs, self.n = data, offs, len(offs) - 1

    def bytes(self, i: int) -> bytes:
        return self.data[self.offs[i] : self.offs[i + 1]].tobytes()

    @cached_property
    def solid(self) -> np.ndarray:
        return ~WHITE[self.data]

    @cached_property
    def leads(self) -> np.ndarray:
        """Code points before each byte."""
        return _before(LEAD[self.data])

    def spans(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of ``inside`` bytes within a document: starts, ends, and for
        each document the index of its first run (one more entry at the end)."""
        if not len(self.data):
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(self.n + 1, np.int64)
        before = np.empty_like(inside)
        before[0], before[1:] = False, inside[:-1]
        before[self.offs[:-1][self.offs[:-1] < len(inside)]] = False
        after = np.empty_like(inside)
        after[-1], after[:-1] = False, inside[1:]
        after[self.offs[1:][self.offs[1:] > 0] - 1] = False
        starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        return starts, ends, np.searchsorted(starts, self.offs)

    @cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.spans(self.solid)

    @cached_property
    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends, and each document's first line; an empty document has one."""
        cuts = np.flatnonzero(self.data == 10)
        starts = np.sort(np.concatenate([self.offs[:-1], cuts + 1]), kind="stable")
        ends = np.sort(np.concatenate([self.offs[1:], cuts]), kind="stable")
        first = np.searchsorted(cuts, self.offs) + np.arange(self.n + 1)
        return starts, ends, first

    def _sums(self, data: np.ndarray) -> np.ndarray:
        h = np.empty(len(data) + 1, _U)
        h[0] = 0
        np.cumsum(_BYTE[data] * _power(len(data) + 1)[0][: len(data)], out=h[1:])
        return h

    @cached_property
    def raw_sums(self) -> np.ndarray:
        return self._sums(self.data)

    @cached_property
    def lower_sums(self) -> np.ndarray:
        return self._sums(LOWER[self.data])

    @staticmethod
    def hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((sums[ends] - sums[starts]) * _power(len(sums))[1][starts] + (ends - starts).astype(_U))


def owners(first: np.ndarray) -> np.ndarray:
    """The document of each of the items that ``first`` deals out."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def windows(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` items within a document, the index of the first item
    of each, and each document's first run."""
    count = np.maximum(np.diff(first) - (k - 1), 0)
    runs = np.zeros(len(first), np.int64)
    np.cumsum(count, out=runs[1:])
    at = np.arange(runs[-1]) + np.repeat(first[:-1] - runs[:-1], count)
    h = np.zeros(len(at), _U)
    for j in range(k):
        h = mix(h + hashes[at + j])
    return h, at, runs


def totals(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sum of ``values`` of each document."""
    return np.diff(_before(values)[offs])


def _before(values: np.ndarray) -> np.ndarray:
    c = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=c[1:])
    return c


def slices(column: pa.Array, limit: int = LIMIT) -> Iterator[tuple[int, int, Text]]:
    """First row, end row and texts of consecutive pieces of the column. Null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offs = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, j, Text(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
        i = j
    give_back()


def pieces(batch: pa.RecordBatch, column: int, limit: int = LIMIT) -> Iterator[tuple[pa.RecordBatch, Text]]:
    """Consecutive rows of the batch with their texts: what is made of them and sent on is
    bounded by ``limit`` too."""
    for i, j, t in slices(batch.column(column), limit):
        yield batch.slice(i, j - i), t


def in_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session now hands rows to Python in batches of at most ``BATCH`` bytes
    (one row, if that is longer). By default ten thousand rows go at a time, or 64 MB."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    n, unit = re.match(r"(\d+)\s*([kmgtp]?)", conf.get(name).lower()).groups()
    if int(n) << 10 * ("kmgtp".index(unit) + 1 if unit else 0) > BATCH:
        conf.set(name, str(BATCH))
    return df


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library
    _trim = None


def give_back() -> None:
    """Freed memory goes back to the system. A worker lives on after its task, and what it
    keeps is lost to all others on the machine."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)

"""Profiles of vector columns from dense accumulators.

A task reads its batches' vectors as one array of numbers, adds them to accumulators of as many
places as the vectors have, and sends a row for each kind and dimension at its end. Spark adds
those rows up. No vector is expanded into rows, and what is shuffled depends on the number of
tasks and dimensions only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .profile import BINS

_NONE = np.zeros(0)


def _values(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Dimension, value (NaN for null) and whether there is one, of all elements."""
    flat = column.flatten()  # of null lists, nothing
    n = np.diff(column.offsets.to_numpy())
    if column.null_count:
        n = n[~column.is_null().to_numpy(zero_copy_only=False)]
    begin = np.cumsum(n) - n
    dim = np.arange(len(flat)) - np.repeat(begin, n)
    return dim, flat.to_numpy(zero_copy_only=False).astype(float), ~flat.is_null().to_numpy(zero_copy_only=False)


def _longer(a: np.ndarray, n: int, fill: float) -> np.ndarray:
    return a if len(a) >= n else np.append(a, np.full(n - len(a), fill, a.dtype))


@dataclass
class Moments:
    """Of each dimension: elements, values, their sum, not finite or null, least and largest
    of the finite values."""

    seen: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    n: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    total: np.ndarray = field(default_factory=lambda: _NONE)
    odd: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    low: np.ndarray = field(default_factory=lambda: _NONE)
    high: np.ndarray = field(default_factory=lambda: _NONE)

    def add(self, column: pa.Array) -> None:
        dim, value, there = _values(column)
        if not len(dim):
            return
        size = max(int(dim.max()) + 1, len(self.n))
        for name, fill in (("seen", 0), ("n", 0), ("total", 0.0), ("odd", 0), ("low", np.inf), ("high", -np.inf)):
            setattr(self, name, _longer(getattr(self, name), size, fill))
        finite = np.isfinite(value)
        self.seen += np.bincount(dim, minlength=size)
        self.n += np.bincount(dim[there], minlength=size)
        # one value after the other, as an aggregate of rows adds them
        self.total = np.bincount(np.append(np.arange(size), dim[there]), np.append(self.total, value[there]), size)
        self.odd += np.bincount(dim[~finite], minlength=size)
        if len(dim) % size == 0 and finite.all() and np.array_equal(dim[:size], np.arange(size)) and (dim.reshape(-1, size) == dim[:size]).all():
            rows = value.reshape(-1, size)
            self.low, self.high = np.minimum(self.low, rows.min(0)), np.maximum(self.high, rows.max(0))
        else:
            np.minimum.at(self.low, dim[finite], value[finite])
            np.maximum.at(self.high, dim[finite], value[finite])


def _there(steps: DataFrame, columns: list[str]) -> tuple[list[str], DataFrame]:
    """The columns that there are, as arrays of doubles."""
    have = [c for c in columns if c in steps.columns]
    return have, steps.select(*[F.col(c).cast("array<double>").alias(f"v{i}") for i, c in enumerate(have)])


def moments(steps: DataFrame, columns: list[str]) -> DataFrame:
    """kind, dim, seen, n, total, odd, low, high (see Moments); low and high are null where no
    value is finite. Columns that are absent are skipped."""
    have, vectors = _there(steps, columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Moments() for _ in have]
        for b in batches:
            for m, c in zip(held, b.columns, strict=True):
                m.add(c)
        for kind, m in zip(have, held, strict=True):
            none = m.low > m.high
            ends = [pa.array(x, pa.float64(), mask=none) for x in (m.low, m.high)]
            yield pa.RecordBatch.from_arrays([pa.array([kind] * len(m.n), pa.string()), pa.array(np.arange(len(m.n))), pa.array(m.seen), pa.array(m.n), pa.array(m.total), pa.array(m.odd), *ends], names)

    names = ["kind", "dim", "seen", "n", "total", "odd", "low", "high"]
    parts = vectors.mapInArrow(run, "kind string, dim long, seen long, n long, total double, odd long, low double, high double")
    return parts.groupBy("kind", "dim").agg(*[F.sum(c).alias(c) for c in names[2:6]], F.min("low").alias("low"), F.max("high").alias("high"))


def means(steps: DataFrame, columns: list[str]) -> DataFrame:
    """kind, dim, mean over all steps, and the number of values."""
    return moments(steps, columns).select("kind", "dim", F.when(F.col("n") > 0, F.col("total") / F.col("n")).alias("mean"), "n")


def nonfinite(steps: DataFrame, columns: list[str]) -> DataFrame:
    return moments(steps, columns).select("kind", "dim", F.col("odd").alias("n_nonfinite"))


def inner_edges(low: float, high: float, bins: int) -> np.ndarray:
    """The edges between equal bins over [low, high]; a single value widens to half a unit on
    both sides."""
    if low == high:
        low, high = low - 0.5, high + 0.5
    return np.arange(1, bins) * ((high - low) / bins) + low


def histogram(steps: DataFrame, columns: list[str], bins: int = BINS) -> DataFrame:
    """kind, dim, bin, n of the bins that hold values: bin i holds edge i <= value < edge i + 1,
    the last also the largest value. Values that are not finite are not binned; see
    ``nonfinite``. The ends, a row a dimension, come to the driver first."""
    ends = moments(steps, columns).where("low IS NOT NULL").select("kind", "dim", "low", "high").collect()
    edges = {(r["kind"], r["dim"]): inner_edges(r["low"], r["high"], bins) for r in ends}
    have, vectors = _there(steps, columns)
    shared = steps.sparkSession.sparkContext.broadcast(edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {k: np.zeros(bins, np.int64) for k in shared.value}
        for b in batches:
            for kind, c in zip(have, b.columns, strict=True):
                dim, value, _ = _values(c)
                finite = np.isfinite(value)
                dim, value = dim[finite], value[finite]
                order = np.argsort(dim, kind="stable")
                cuts = np.append(np.flatnonzero(np.diff(dim[order], prepend=-1)), len(dim)).astype(int)
                for x, y in zip(cuts, cuts[1:], strict=False):
                    d = int(dim[order[x]])
                    counts[kind, d] += np.bincount(np.searchsorted(shared.value[kind, d], value[order[x:y]], "right"), minlength=bins)
        found = [(k, d, i, int(n)) for (k, d), row in counts.items() for i, n in enumerate(row) if n]
        columns = zip(*found, strict=True) if found else ([], [], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["kind", "dim", "bin", "n"])

    parts = vectors.mapInArrow(run, "kind string, dim long, bin long, n long")
    return parts.groupBy("kind", "dim", "bin").agg(F.sum("n").alias("n"))

"""Bloom filters of 64-bit hashes, built in parts and merged by segment.

A task reports the bit positions of its own hashes, cut into segments; each segment is
merged in one place, so no task or message grows with the number of tasks times the size
of the filter. ``bits`` bounds the result, which the driver holds and broadcasts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import mix

SEGMENT = 1 << 16  # bits
HASHES = 3
PARTS = "segment long, once binary"


def positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    step = mix(hashes) | np.uint64(1)
    return np.stack([mix(hashes + np.uint64(i) * step) % np.uint64(bits) for i in range(HASHES)]).astype(np.int64)


def size_for(count: int, most: int) -> int:
    """A power of two: 12 bits and more for each hash, but not more than ``most``."""
    bits = SEGMENT
    while bits < most and bits < 12 * count:
        bits *= 2
    return bits


def build(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """The filter of a long column, as bytes, little bits first."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.unique(positions(b.column(0).to_numpy().view(np.uint64), bits))
            seg = np.unique(at // SEGMENT)
            cut = np.searchsorted(at, np.append(seg, seg[-1:] + 1) * SEGMENT)
            yield pa.RecordBatch.from_arrays([pa.array(seg, pa.int64()), pa.array([(at[i:j] % SEGMENT).astype("<u2").tobytes() for i, j in zip(cut, cut[1:])], pa.binary())], ["segment", "once"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, np.ndarray] = {}
        for b in batches:
            for s, once in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                seen.setdefault(s, np.zeros(SEGMENT, bool))[np.frombuffer(once, "<u2")] = True
        for s, have in seen.items():
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int64()), pa.array([np.packbits(have, bitorder="little").tobytes()], pa.binary())], ["segment", "once"])

    out = np.zeros(bits // 8, np.uint8)
    for r in df.select(column).where(F.col(column).isNotNull()).mapInArrow(scan, PARTS).repartition(F.col("segment")).mapInArrow(merge, PARTS).collect():
        out[r["segment"] * SEGMENT // 8 :][: SEGMENT // 8] = np.frombuffer(r["once"], np.uint8)
    return out


def contains(have: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = positions(hashes, len(have) * 8)
    return ((have[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(0)

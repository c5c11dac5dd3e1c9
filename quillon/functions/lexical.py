"""A text encoder that is trained on the corpus: weighted words in a space of fixed size.

A word goes to a dimension and a sign by its md5, and weighs as much as it is rare: the
logarithm of how many texts hold a word of its bucket, which ``train`` counts over all texts.
Vectors have length 1, so their products tell how many rare words two texts share. It knows no
meanings, orders or synonyms; where a trained network is at hand, give it the same interface.

The model is BUCKETS numbers, however large the corpus. Words are maximal runs of letters,
digits and characters beyond ASCII, A-Z lower-cased. Null texts have no vector, texts without
a word have the zero vector.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16  # of rarity
PIECE = 1 << 10  # vectors that are made at a time
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str) -> list[str]:
    return _WORD.findall(text.translate(_LOWER))


@lru_cache(1 << 18)
def place(word: str) -> tuple[int, float, int]:
    """A number for the dimension, the sign, and the bucket of rarity."""
    h = md5(word.encode()).hexdigest()
    return int(h[:8], 16), 1.0 if h[8] >= "8" else -1.0, int(h[9:13], 16)


class LexicalEmbedder:
    """``weights``: of each bucket. ``train`` makes one."""

    def __init__(self, weights: np.ndarray, size: int = 512):
        if len(weights) != BUCKETS:
            raise ValueError(f"{len(weights)} weights, not {BUCKETS}")
        self.weights, self.size = weights, size

    def vectors(self, texts: list[str]) -> np.ndarray:
        rows, dims, values = [], [], []
        for i, text in enumerate(texts):
            for word, n in Counter(words(text)).items():
                dim, sign, bucket = place(word)
                rows.append(i)
                dims.append(dim % self.size)
                values.append(sign * n * self.weights[bucket])
        out = np.bincount(np.array(rows, np.int64) * self.size + np.array(dims, np.int64), np.array(values), len(texts) * self.size).reshape(len(texts), self.size)
        return (out / np.maximum(np.sqrt((out * out).sum(1, keepdims=True)), 1e-300)).astype(np.float32)

    def column(self, text: Column) -> Column:
        @F.arrow_udf("array<float>")
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for b in batches:
                made = []
                for i in range(0, max(len(b), 1), PIECE):
                    part = b.slice(i, PIECE)
                    flat = pa.array(self.vectors(part.drop_null().to_pylist()).ravel(), pa.float32())
                    there = np.append(0, np.cumsum(part.is_valid().to_numpy(zero_copy_only=False))) * self.size
                    made.append(pa.ListArray.from_arrays(pa.array(there, pa.int32()), flat, mask=part.is_null()))
                yield pa.concat_arrays(made)

        return run(text)


def train(texts: DataFrame, text: str, size: int = 512) -> LexicalEmbedder:
    """Weights from all texts that are not null: ln((1 + texts) / (1 + texts of the bucket)) + 1."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(BUCKETS, np.int64), 0
        for b in batches:
            for t in b.column(0).to_pylist():
                seen[list({place(w)[2] for w in words(t)})] += 1
                n += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *at.tolist()], pa.int64()), pa.array([n, *seen[at].tolist()], pa.int64())], ["bucket", "n"])

    found = texts.select(text).where(F.col(text).isNotNull()).mapInArrow(count, "bucket long, n long")
    rows = dict(map(tuple, found.groupBy("bucket").agg(F.sum("n").alias("n")).collect()))  # BUCKETS at most
    total = rows.pop(-1, 0)
    seen = np.zeros(BUCKETS)
    for k, n in rows.items():
        seen[k] = n
    return LexicalEmbedder(np.log((1 + total) / (1 + seen)) + 1, size)


def similarity(a: Column, b: Column) -> Column:
    """The product of two vectors of length 1."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)

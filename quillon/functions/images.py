"""Images as row-major HWC bytes: Lanczos resize, strips, and the PNG container.

Resizing is separable: one fixed-point weight matrix for each axis, applied as two integer
matrix products with rounding and clipping to a byte between them. The weights depend on
the two sizes only. All functions take and give Arrow batches.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

BITS = 22  # of a weight's fraction
LOBES = 3
PIECE = 64


def _kernel(x: float) -> float:
    if x == 0:
        return 1.0
    if abs(x) >= LOBES:
        return 0.0
    return math.sin(math.pi * x) / (math.pi * x) * math.sin(math.pi * x / LOBES) / (math.pi * x / LOBES)


@lru_cache
def weights(old: int, new: int) -> np.ndarray:
    """The (new, old) matrix of weights, each row normalised and then rounded."""
    scale = old / new
    wide = max(scale, 1.0)
    out = np.zeros((new, old), np.int64)
    for i in range(new):
        center = (i + 0.5) * scale
        low, high = max(0, int(center - LOBES * wide + 0.5)), min(old, int(center + LOBES * wide + 0.5))
        row = np.array([_kernel((j - center + 0.5) / wide) for j in range(low, high)])
        row *= (1 << BITS) / row.sum()
        out[i, low:high] = np.where(row < 0, np.ceil(row - 0.5), np.floor(row + 0.5)).astype(np.int64)
    return out


def _byte(x: np.ndarray) -> np.ndarray:
    return np.clip((x + (1 << (BITS - 1))) >> BITS, 0, 255)


def resized(image: np.ndarray, height: int, width: int) -> np.ndarray:
    h, w, _ = image.shape
    # integers below 2 ** 53: doubles hold them exactly, and their products are faster
    x = _byte(np.matmul(weights(w, width).astype(float), image.astype(float)).astype(np.int64))
    y = weights(h, height).astype(float) @ x.reshape(h, -1).astype(float)
    return _byte(y.astype(np.int64)).reshape(height, width, -1).astype(np.uint8)


def in_pieces(batches: Iterator[pd.Series], of: Callable) -> Iterator[pd.Series]:
    """``of`` each value, given back some images at a time: a batch of them is large."""
    for s in batches:
        for i in range(0, len(s), PIECE):
            yield s.iloc[i : i + PIECE].map(of)


def resize(image: Column, old: tuple[int, int, int], new: tuple[int, int]) -> Column:
    """Bytes of shape ``old`` to bytes of (*new, channels). Bytes of another length, and
    null, give null."""

    @pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return in_pieces(batches, lambda x: resized(np.frombuffer(x, np.uint8).reshape(old), *new).tobytes() if x is not None and len(x) == math.prod(old) else None)

    return run(image)


def strip(images: Column, shape: tuple[int, int, int]) -> Column:
    """An array of images side by side: row by row, the images' rows follow one another. No
    image makes the empty strip, null stays null."""
    h, w, c = shape

    @F.arrow_udf("binary")
    def run(column: pa.Array) -> pa.Array:
        out = []
        for x in column:
            frames = None if not x.is_valid else np.frombuffer(b"".join(x.as_py()), np.uint8).reshape(-1, h, w * c)
            out.append(None if frames is None else frames.transpose(1, 0, 2).tobytes())
        return pa.array(out, pa.binary())

    return run(images)


# --- PNG, 8-bit RGB without interlacing

_SIGN = b"\x89PNG\r\n\x1a\n"


def _guesses(left: np.ndarray, up: np.ndarray, corner: np.ndarray) -> list[np.ndarray]:
    """What each of the five row filters takes a byte to be from three neighbours (int16)."""
    to_left, to_up = np.abs(up - corner), np.abs(left - corner)
    to_corner = np.abs(left + up - 2 * corner)
    nearest = np.where((to_left <= to_up) & (to_left <= to_corner), left, np.where(to_up <= to_corner, up, corner))
    return [np.zeros_like(left), left, up, (left + up) >> 1, nearest]


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def to_pngs(images: np.ndarray) -> list[bytes]:
    """The files of images of shape (n, height, width, 3). Each row takes the filter that
    leaves the least sum of distances from 0, the usual guess at what compresses best."""
    n, h, w, c = images.shape
    x = images.astype(np.int16)
    around = np.zeros((n, h + 1, w + 1, c), np.int16)
    around[:, 1:, 1:] = x
    best, rows = np.full((n, h), 1 << 30), np.zeros((n, h, 1 + w * c), np.uint8)
    for kind, guess in enumerate(_guesses(around[:, 1:, :-1], around[:, :-1, 1:], around[:, :-1, :-1])):
        rest = (x - guess).astype(np.uint8).reshape(n, h, -1)
        cost = np.minimum(rest, 0 - rest).sum(2, dtype=np.int64)
        better = cost < best
        best[better] = cost[better]
        rows[better, 0] = kind
        rows[better, 1:] = rest[better]
    head = _chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0))
    return [_SIGN + head + _chunk(b"IDAT", zlib.compress(r.tobytes())) + _chunk(b"IEND", b"") for r in rows]


def _parsed(png: bytes) -> tuple[int, int, np.ndarray]:
    """Height, width and the filtered rows."""
    if png[:8] != _SIGN:
        raise ValueError("not a PNG")
    at, data, head = 8, [], None
    while at < len(png):
        n, kind = struct.unpack(">I4s", png[at : at + 8])
        body = png[at + 8 : at + 8 + n]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            data.append(body)
        at += n + 12
    if head is None or head[2:] != (8, 2, 0, 0, 0):
        raise ValueError("only 8-bit RGB without interlacing")
    rows = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(head[1], 1 + 3 * head[0])
    if rows[:, 0].max(initial=0) > 4:
        raise ValueError("unknown row filter")
    return head[1], head[0], rows


def _unfiltered(rows: np.ndarray, w: int) -> np.ndarray:
    """Pixels of images (n, height, width, 3) from their filtered rows. A byte needs those to
    the left and above, so the pixels of a diagonal, of all images, are made in one step."""
    n, h = rows.shape[:2]
    kind = np.repeat(rows[:, :, 0].T, 3, axis=1)  # (height, 3 n), as the pixels below
    rest = np.ascontiguousarray(rows[:, :, 1:].reshape(n, h, w, 3).transpose(1, 2, 0, 3)).reshape(h, w, 3 * n).astype(np.int16)
    out = np.zeros((h + 1, w + 1, 3 * n), np.int16)
    for k in range(h + w - 1):
        y = np.arange(max(0, k - w + 1), min(h, k + 1))
        x = k - y
        guess = np.choose(kind[y], _guesses(out[y + 1, x], out[y, x + 1], out[y, x]))
        out[y + 1, x + 1] = (rest[y, x] + guess) & 255
    return out[1:, 1:].astype(np.uint8).reshape(h, w, n, 3).transpose(2, 0, 1, 3)


def from_pngs(pngs: list[bytes]) -> list[np.ndarray]:
    """Pixels of shape (height, width, 3)."""
    parsed = [_parsed(x) for x in pngs]
    out: list = [None] * len(pngs)
    for size in {(h, w) for h, w, _ in parsed}:
        of = [i for i, p in enumerate(parsed) if p[:2] == size]
        for i, pixels in zip(of, _unfiltered(np.stack([parsed[i][2] for i in of]), size[1]), strict=True):
            out[i] = pixels
    return out


def to_png(image: bytes, height: int, width: int) -> bytes:
    return to_pngs(np.frombuffer(image, np.uint8).reshape(1, height, width, 3))[0]


def from_png(png: bytes) -> tuple[bytes, int, int]:
    """Pixels, height and width."""
    pixels = from_pngs([png])[0]
    return pixels.tobytes(), *pixels.shape[:2]


def _present(values: list, of: Callable[[list], list]) -> list:
    """``of`` the values that are not null."""
    made = iter(of([x for x in values if x is not None]))
    return [None if x is None else next(made) for x in values]


def _encoded(images: list[bytes], height: int, width: int) -> list[bytes]:
    """Bytes of another number than the shape's are an error."""
    return to_pngs(np.frombuffer(b"".join(images), np.uint8).reshape(len(images), height, width, 3)) if images else []


def encode_png(image: Column, height: int, width: int) -> Column:
    @pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            for i in range(0, len(s), PIECE):
                yield pd.Series(_present(s.iloc[i : i + PIECE].tolist(), lambda x: _encoded(x, height, width)), dtype=object)

    return run(image)


def decode_png(png: Column) -> Column:
    @pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            for i in range(0, len(s), PIECE):
                yield pd.Series(_present(s.iloc[i : i + PIECE].tolist(), lambda x: [y.tobytes() for y in from_pngs(x)]), dtype=object)

    return run(png)


def encode_columns(df: DataFrame, shapes: dict[str, tuple[int, int, int]]) -> DataFrame:
    """``df`` with its columns of pixels as PNG. Rows pass through tasks in batches, some
    images of a batch at a time; a column expression would hold the rows back meanwhile."""
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, PIECE):
                b = whole.slice(i, PIECE)
                made = {c: pa.array(_present(b.column(names.index(c)).to_pylist(), lambda x, s=s: _encoded(x, s[0], s[1])), pa.binary()) for c, s in shapes.items()}
                yield pa.RecordBatch.from_arrays([made.get(c, b.column(k)) for k, c in enumerate(names)], names)

    return df.mapInArrow(run, df.schema)

"""Record files of framed Example messages, registered as the format ``tfrecord``.

A record is its length, a masked CRC-32C of the length, the message, and a masked CRC-32C of
the message. A message maps names to lists of bytes, 32-bit floats or 64-bit integers.

Columns: string, binary, float, long, integer, boolean, and arrays of them. A null column is no
entry of the message, and what is no entry, or an empty list where one value is declared, is
read as null. A null within an array is an error, as are doubles, which records do not hold.
A bad checksum or a cut file is an error that names the file and the place.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .store import FolderWriter, listed, opened, part_bytes, shared_out

PART_BYTES = 1 << 27
FILE_BYTES = 1 << 28  # of a file, after which a task begins another
BATCH_BYTES = 1 << 24  # of records that are coded together
BLOCK = 1 << 10


# --- checksums


@lru_cache
def _table() -> np.ndarray:
    """CRC-32C (its reflected polynomial is a fixed value) of each byte."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, np.uint32(0x82F63B78) ^ (t >> np.uint32(1)), t >> np.uint32(1))
    return t


def _step(state: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return _table()[(state ^ byte) & np.uint32(255)] ^ (state >> np.uint32(8))


@lru_cache
def _over_block() -> np.ndarray:
    """What BLOCK zero bytes make of a state, by its four bytes: the code is linear."""
    state = (np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], np.uint32)).astype(np.uint32)
    for _ in range(BLOCK):
        state = _step(state, np.uint32(0))
    return state


def _lanes(data: np.ndarray, at: np.ndarray, size: np.ndarray, state: np.ndarray) -> np.ndarray:
    """States after ``size`` bytes from ``at``, all lanes together; longest lanes first."""
    order = np.argsort(-size, kind="stable")
    at, left, out = at[order], size[order], state[order]
    for j in range(int(left[0]) if len(left) else 0):
        n = np.searchsorted(-left, -j, "left")  # lanes of more than j bytes
        out[:n] = _step(out[:n], data[at[:n] + j].astype(np.uint32))
    back = np.empty_like(out)
    back[order] = out
    return back


def masked_crcs(records: list[bytes]) -> np.ndarray:
    """The masked CRC-32C of each record. Whole blocks of all records are summed side by side,
    then joined in order, then each record's rest follows."""
    size = np.array([len(r) for r in records], np.int64)
    begin = np.cumsum(size) - size
    data = np.frombuffer(b"".join(records), np.uint8)
    blocks = size // BLOCK
    first = np.cumsum(blocks) - blocks
    of = np.repeat(np.arange(len(records)), blocks)
    starts = begin[of] + (np.arange(len(of)) - first[of]) * BLOCK
    each = _lanes(data, starts, np.full(len(of), BLOCK, np.int64), np.zeros(len(of), np.uint32))
    state, over = np.full(len(records), 0xFFFFFFFF, np.uint32), _over_block()
    for k in range(int(blocks.max(initial=0))):
        i = np.flatnonzero(blocks > k)
        s = state[i]
        moved = over[0][s & 255] ^ over[1][s >> 8 & 255] ^ over[2][s >> 16 & 255] ^ over[3][s >> 24]
        state[i] = moved ^ each[first[i] + k]
    crc = ~_lanes(data, begin + blocks * BLOCK, size - blocks * BLOCK, state)
    turned = (crc >> np.uint32(15)) | (crc << np.uint32(17))
    return (turned.astype(np.uint64) + 0xA282EAD8 & 0xFFFFFFFF).astype(np.uint32)  # the mask is a fixed value


def framed(records: list[bytes]) -> bytes:
    heads = [struct.pack("<Q", len(r)) for r in records]
    both = zip(heads, masked_crcs(heads).tolist(), records, masked_crcs(records).tolist(), strict=True)
    return b"".join([x for h, a, r, b in both for x in (h, struct.pack("<I", a), r, struct.pack("<I", b))])


def unframed(stream, name: str, most: int = BATCH_BYTES) -> Iterator[list[bytes]]:
    """The records of a file, some at a time, their checksums compared."""
    at, held, total = 0, [], 0

    def checked() -> list[bytes]:
        heads, records = [h[:8] for _, h, _, _ in held], [r for _, _, r, _ in held]
        for parts, crcs in ((heads, [h[8:] for _, h, _, _ in held]), (records, [c for _, _, _, c in held])):
            for i, (want, have) in enumerate(zip(crcs, masked_crcs(parts).tolist(), strict=True)):
                if struct.unpack("<I", want)[0] != have:
                    raise ValueError(f"{name}: bad checksum in the record at byte {held[i][0]}")
        return records

    while head := stream.read(12):
        if len(head) == 12 and masked_crcs([head[:8]])[0] != struct.unpack("<I", head[8:])[0]:
            raise ValueError(f"{name}: bad checksum in the record at byte {at}")  # else its length would be believed
        n = struct.unpack("<Q", head[:8])[0] if len(head) == 12 else 0
        record, crc = (stream.read(n), stream.read(4)) if len(head) == 12 else (b"", b"")
        if len(record) != n or len(crc) != 4:
            raise ValueError(f"{name}: cut off in the record at byte {at}")
        held.append((at, head, record, crc))
        at, total = at + n + 16, total + n
        if total >= most:
            yield checked()
            held, total = [], 0
    if held:
        yield checked()


# --- messages


def _varint(n: int) -> bytes:
    out = bytearray()
    n &= (1 << 64) - 1
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _sized(tag: int, body: bytes) -> bytes:
    return bytes([tag << 3 | 2]) + _varint(len(body)) + body


def kind_of(t: T.DataType) -> tuple[int, bool]:
    """The list that a column goes to (1 bytes, 2 floats, 3 integers), and if it is an array."""
    many = isinstance(t, T.ArrayType)
    inner = t.elementType if many else t
    for kind, types in ((1, (T.StringType, T.BinaryType)), (2, (T.FloatType,)), (3, (T.LongType, T.IntegerType, T.BooleanType))):
        if isinstance(inner, types):
            return kind, many
    raise ValueError(f"records do not hold {t.simpleString()}")


def example(row: dict, kinds: dict[str, tuple[int, bool]]) -> bytes:
    """The message of a row, names in order."""
    entries = []
    for name in sorted(kinds):
        value, (kind, many) = row[name], kinds[name]
        if value is None:
            continue
        values = value if many else [value]
        if any(x is None for x in values):
            raise ValueError(f"{name}: records hold no null within an array")
        if kind == 1:
            body = b"".join([_sized(1, x.encode() if isinstance(x, str) else bytes(x)) for x in values])
        elif kind == 2:
            body = _sized(1, np.asarray(values, "<f4").tobytes()) if len(values) else b""
        else:
            body = _sized(1, b"".join([_varint(int(x)) for x in values])) if len(values) else b""
        entries.append(_sized(1, _sized(1, name.encode()) + _sized(2, _sized(kind, body))))
    return _sized(1, b"".join(entries))


def _fields(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Number, wire type and content of a message's fields; a number's content is its varint."""
    at = 0

    def number() -> int:
        nonlocal at
        n = shift = 0
        while True:
            b = data[at]
            at += 1
            n |= (b & 127) << shift
            shift += 7
            if b < 128:
                return n

    while at < len(data):
        tag = number()
        if tag & 7 == 2:
            n = number()
            if at + n > len(data):
                raise ValueError("a field goes on beyond its message")
            yield tag >> 3, 2, data[at : at + n]
            at += n
        elif tag & 7 == 5:
            yield tag >> 3, 5, data[at : at + 4]
            at += 4
        elif tag & 7 == 0:
            begin = at
            number()
            yield tag >> 3, 0, data[begin:at]
        else:
            raise ValueError(f"wire type {tag & 7} in an example")


def _integers(data: bytes) -> list[int]:
    out, n, shift = [], 0, 0
    for b in data:
        n |= (b & 127) << shift
        shift += 7
        if b < 128:
            out.append((n & (1 << 64) - 1) - (1 << 64 if n >> 63 & 1 else 0))
            n = shift = 0
    return out


def parsed(message: bytes, wanted: set[str]) -> dict[str, tuple[int, list]]:
    """Kind and values of the wanted names; others are passed over unread."""
    out = {}
    for _, _, features in (x for x in _fields(message) if x[0] == 1):
        for _, _, entry in _fields(features):
            parts = {number: body for number, _, body in _fields(entry)}
            name = parts.get(1, b"").decode()
            if name not in wanted:
                continue
            for kind, _, body in _fields(parts.get(2, b"")):
                values: list = []
                for _, wire, x in _fields(body):
                    if kind == 1:
                        values.append(x)
                    elif kind == 2:
                        values += np.frombuffer(x, "<f4").tolist()  # packed, or one
                    else:
                        values += _integers(x)
                    if (kind, wire) in ((1, 0), (1, 5), (2, 0), (3, 5)):
                        raise ValueError(f"{name}: not a list of its kind")
                out[name] = kind, values
    return out


# --- the format


@dataclass
class Part(InputPartition):
    paths: list[str]


class _Reader(DataSourceReader):
    def __init__(self, schema: T.StructType, path: str, most: str | None):
        self.schema, self.path, self.most = schema, path, most
        self.kinds = {f.name: kind_of(f.dataType) for f in schema}

    def partitions(self) -> list[Part]:
        files = listed(self.path)
        return [Part(x) for x in shared_out(files, part_bytes(files, self.most, PART_BYTES))] or [Part([])]

    def _value(self, name: str, found: dict[str, tuple[int, list]]):
        if name not in found:
            return None
        (kind, values), (want, many) = found[name], self.kinds[name]
        if kind != want:
            raise ValueError(f"{name}: the record has another kind of list")
        t = self.schema[name].dataType
        inner = t.elementType if many else t
        if isinstance(inner, T.StringType):
            values = [x.decode() for x in values]
        elif isinstance(inner, T.BooleanType):
            values = [bool(x) for x in values]
        if not many and len(values) > 1:
            raise ValueError(f"{name}: {len(values)} values where one is declared")
        return values if many else values[0] if values else None

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, names = to_arrow_schema(self.schema), set(self.kinds)
        for path in partition.paths:
            store, name = opened(path)
            with store.open_input_stream(name) as stream:
                for records in unframed(stream, path):
                    found = [parsed(r, names) for r in records]
                    yield pa.RecordBatch.from_arrays([pa.array([self._value(f.name, x) for x in found], f.type) for f in arrow], schema=arrow)


class _Writer(FolderWriter):
    def __init__(self, folder: str, overwrite: bool, schema: T.StructType, most: int):
        super().__init__(folder, overwrite)
        self.kinds, self.most = {f.name: kind_of(f.dataType) for f in schema}, most

    def files(self, batches: Iterator, store, folder: str) -> int:
        rows, n, out, held = 0, 0, None, 0
        try:
            for b in batches:
                step = max(1, int(BATCH_BYTES * b.num_rows / max(b.nbytes, 1)))
                for i in range(0, b.num_rows, step):
                    data = framed([example(r, self.kinds) for r in b.slice(i, step).to_pylist()])
                    if out is None or held + len(data) > self.most:
                        if out is not None:
                            out.close()
                        out, held, n = store.open_output_stream(f"{folder}/{n:05d}.tfrecord"), 0, n + 1
                    out.write(data)
                    held += len(data)
                rows += b.num_rows
        finally:
            if out is not None:
                out.close()
        return rows


class TFRecords(DataSource):
    """Options: ``path``, ``partitionBytes``, ``fileBytes``. Reading needs a schema, and reads
    the columns that it has."""

    @classmethod
    def name(cls) -> str:
        return "tfrecord"

    def schema(self) -> str:
        raise ValueError("declare the columns to read: records have no schema")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(schema, self.options["path"], self.options.get("partitionbytes"))

    def writer(self, schema: T.StructType, overwrite: bool) -> FolderWriter:
        return _Writer(self.options["path"], overwrite, schema, int(self.options.get("filebytes", FILE_BYTES)))


def read(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    spark.dataSource.register(TFRecords)
    return spark.read.format("tfrecord").schema(schema).load(path)


def write(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """One commit for all tasks."""
    df.sparkSession.dataSource.register(TFRecords)
    df.write.format("tfrecord").mode("overwrite" if overwrite else "append").save(path)

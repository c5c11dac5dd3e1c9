"""Token ids in files: frequency-ranked ids in a byte-aligned variable-length code.

The most frequent id of the corpus is rank 0. A rank takes one to four bytes, the number
of bytes goes to separate control bytes, two bits for each rank, so that numpy decodes a
block with one table lookup for the control bytes and four masked gathers.

A store is a folder of two Parquet tables, which Spark writes and commits, so any file
system that Spark reaches can hold it and a lost task is redone without a trace:

* ``ids``: rank, id, count, the code book;
* ``blocks``, uncompressed: start (ids of all blocks before), doc_ids, lengths, control,
  data. Blocks follow one another in ascending document id.

Defined results: null and empty texts are the end id alone; rows with equal document id
are kept, in order of their texts; a null document id comes first; an empty table gives a
store without blocks; other columns are not stored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scan import in_batches
from .staging import stage
from .tokens import encoded

END = 0
BLOCK = 1 << 20  # ids of a block, or one document's
_BYTES = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.int64) + 1  # of a control byte's four ranks


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes."""
    ranks = ranks.astype("<u4")
    n = 1 + (ranks > 0xFF) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    two = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    two[: len(ranks)] = n - 1
    control = (two.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1).astype(np.uint8)
    return control.tobytes(), ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) < n[:, None]].tobytes()


def decode_ranks(control: bytes, data: bytes, count: int) -> np.ndarray:
    n = _BYTES[np.frombuffer(control, np.uint8)].ravel()[:count]
    at, d = np.cumsum(n) - n, np.frombuffer(data, np.uint8)
    out = d[at].astype(np.uint32)
    for k in range(1, 4):
        more = np.flatnonzero(n > k)
        if not len(more):
            break
        out[more] |= d[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def _tokenised(docs: DataFrame, tokenizer: str, key: str, text: str, end: int) -> DataFrame:
    """In ascending key: part, start within the part, key, ids as 16-bit pairs (low, high
    planes, which compress better) and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, start = TaskContext.get().partitionId(), 0
        for b in batches:
            starts, ns, ids = [], [], []
            for _, x in encoded(b.column(1), tokenizer, end):
                starts.append(start)
                ns.append(len(x))
                start += len(x)
                ids.append(x.astype("<u2").tobytes() if x.max() < 1 << 16 else b"\0" + x.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([part] * b.num_rows, pa.int64()), pa.array(starts, pa.int64()), b.column(0), pa.array(ns, pa.int64()), pa.array(ids, pa.binary())], ["part", "start", "key", "n", "ids"])

    kind = docs.schema[key].dataType.simpleString()
    ordered = in_batches(docs.select(key, text)).repartitionByRange(F.col(key).asc_nulls_first()).sortWithinPartitions(F.col(key).asc_nulls_first(), F.col(text).asc_nulls_first())
    return ordered.mapInArrow(run, f"part long, start long, key {kind}, n long, ids binary")


def _unpacked(ids: bytes) -> np.ndarray:
    """Two bytes an id, or after one more byte (an odd length) four."""
    return np.frombuffer(ids, "<u4", offset=1) if len(ids) % 2 else np.frombuffer(ids, "<u2")


def write(docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text", end: int = END) -> None:
    spark = docs.sparkSession
    tokens = stage(_tokenised(docs, tokenizer, key, text, end), "tokens")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << 16, np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            c = np.bincount(np.concatenate([_unpacked(x) for x in b.column(0).to_pylist()]))  # a batch is bounded in bytes
            if len(c) > len(seen):
                seen = np.append(seen, np.zeros(len(c) - len(seen), np.int64))
            seen[: len(c)] += c
        ids = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(seen[ids], pa.int64())], ["id", "count"])

    counted = tokens.select("ids").mapInArrow(count, "id long, count long").groupBy("id").agg(F.sum("count").alias("count"))
    book = sorted(((r["id"], r["count"]) for r in counted.collect()), key=lambda x: (-x[1], x[0]))  # the vocabulary at most
    spark.createDataFrame([(i, *x) for i, x in enumerate(book)], "rank long, id long, count long").coalesce(1).write.parquet(f"{path}/ids")
    rank = np.zeros(max((i for i, _ in book), default=0) + 1, np.uint32)
    rank[[i for i, _ in book]] = np.arange(len(book))
    totals = sorted((r["part"], r["n"]) for r in tokens.groupBy("part").agg(F.sum("n").alias("n")).collect())  # a row a partition
    base = dict(zip([p for p, _ in totals], np.cumsum([0, *(n for _, n in totals)]).tolist(), strict=False))
    shared = spark.sparkContext.broadcast((rank, base))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, base = shared.value

        def block(keys: list, ids: list, start: int) -> pa.RecordBatch:
            control, data = encode_ranks(rank[np.concatenate(ids)])
            keys = pa.concat_arrays(keys)
            doc_ids = pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys)
            lengths = pa.array([[len(x) for x in ids]], pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array([start], pa.int64()), doc_ids, lengths, pa.array([control], pa.binary()), pa.array([data], pa.binary())], ["start", "doc_ids", "lengths", "control", "data"])

        keys, ids, held, first, follows = [], [], 0, 0, None
        for b in batches:
            for i, (part, start, x) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(4).to_pylist(), strict=True)):
                at, x = base[part] + start, _unpacked(x)
                if ids and (held + len(x) > BLOCK or at != follows):
                    yield block(keys, ids, first)
                    keys, ids, held = [], [], 0
                if not ids:
                    first = at
                keys.append(b.column(2).slice(i, 1))
                ids.append(x)
                held += len(x)
                follows = at + len(x)
        if ids:
            yield block(keys, ids, first)

    kind = docs.schema[key].dataType.simpleString()
    blocks = tokens.mapInArrow(encode, f"start long, doc_ids array<{kind}>, lengths array<long>, control binary, data binary")
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str, key: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """Of each document in the store: key, start, n_tokens, ids_crc32, and ids if asked for."""
    blocks = spark.read.parquet(f"{path}/blocks")
    book = spark.read.parquet(f"{path}/ids").orderBy("rank").collect()  # the vocabulary at most
    shared = spark.sparkContext.broadcast(np.array([r["id"] for r in book], "<u4"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = shared.value
        for b in batches:
            for i in range(b.num_rows):
                start, keys, lengths, control, data = (c[i] for c in b.columns)
                n = np.array(lengths.as_py(), np.int64)
                ends = np.cumsum(n)
                ids = book[decode_ranks(control.as_py(), data.as_py(), int(n.sum()))]
                parts = [ids[e - x : e] for e, x in zip(ends.tolist(), n.tolist(), strict=True)]
                columns = [keys.values, pa.array(start.as_py() + ends - n, pa.int64()), pa.array(n, pa.int64()), pa.array([zlib.crc32(x.tobytes()) for x in parts], pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, *([pa.array([x.astype(np.int64) for x in parts], pa.list_(pa.int64()))] if with_ids else [])], ["key", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])])

    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    out = blocks.select("start", "doc_ids", "lengths", "control", "data").mapInArrow(run, f"key {kind}, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)
    return out.withColumnRenamed("key", key)

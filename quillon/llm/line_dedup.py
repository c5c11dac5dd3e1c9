"""Line deduplication over documents.

A line's key is the line stripped of ASCII white space and lower-cased (A-Z). Keys that
are long enough and occur in several documents lose all their lines but those in the
keeper, the largest document id that holds the key.

Two Bloom filters over all keys find the suspects: one of hashes seen in a document, one
of hashes seen in a second document. Each task reports the bit positions of its own keys;
a position that a second task (or a second document of the same task) reports is set in
the second filter. A key of two documents therefore always passes the second filter, and
only keys that pass it are shuffled, as (128-bit digest, document id), to be counted
exactly. The filters' size follows the number of lines up to ``max_bits``; beyond it more
keys are suspected, and the result stays the same. Texts are scanned, never shuffled,
unless the confirmed keys outgrow ``max_keys``, when the lines to drop are joined back.

Defined results: a null or empty text is one empty line (and stays as it is); rows with equal
document id count as one document, also if the rows are equal; ids may be of any type that
has an order; a null document id is no document (its lines are neither counted nor dropped);
very long texts and lines are taken whole; an empty table stays empty; extra columns pass
through ``dedup``, whatever their names, but for line_count and line_drops, which are new.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from .scan import Text, in_batches, mix, owners, pieces, slices
from .staging import free_name, stage

MIN_CHARS, MIN_DOCS = 20, 3
_SEGMENT = 1 << 16  # bits
_HASHES = 3


def _keys(t: Text, min_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of lines whose key is long enough: the line, the key's start and end, its hash."""
    starts, ends, _ = t.lines
    solid = np.flatnonzero(t.solid)
    if not len(solid):
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    lo, hi = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    line = np.flatnonzero(hi > lo)
    lo, hi = solid[lo[line]], solid[hi[line] - 1] + 1
    long = t.leads[hi] - t.leads[lo] >= min_chars
    line, lo, hi = line[long], lo[long], hi[long]
    return line, lo, hi, t.hashes(t.lower_sums, lo, hi)


def _positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bit positions of each hash, one row for each of the hash functions."""
    step = mix(hashes) | np.uint64(1)
    return np.stack([mix(hashes + np.uint64(i) * step) % np.uint64(bits) for i in range(_HASHES)]).astype(np.int64)


def _segments(once: np.ndarray, twice: np.ndarray) -> Iterator[pa.RecordBatch]:
    seg = np.unique(np.concatenate([once, twice]) // _SEGMENT)
    rows = [[x[np.searchsorted(x, s * _SEGMENT) : np.searchsorted(x, (s + 1) * _SEGMENT)] % _SEGMENT for s in seg] for x in (once, twice)]
    yield pa.RecordBatch.from_arrays([pa.array(seg, pa.int64()), *(pa.array([v.astype("<u2").tobytes() for v in r], pa.binary()) for r in rows)], ["segment", "once", "twice"])


def twice_filter(docs: DataFrame, key: str, text: str, min_chars: int, bits: int) -> np.ndarray:
    """The second filter as bytes, little bits first."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        held = 0
        for b in batches:
            b = b.filter(b.column(0).is_valid())
            doc = b.column(2).to_numpy(zero_copy_only=False)
            for i, _, t in slices(b.column(1)):
                line, _, _, h = _keys(t, min_chars)
                keys.append(h)
                ids.append(doc[i:][owners(t.lines[2])[line]])
                held += len(h)
                if held > 1 << 18:  # a key on both sides of this cut is reported twice, as from two tasks
                    yield from report(keys, ids)
                    keys, ids, held = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
        yield from report(keys, ids)

    def report(keys: list, ids: list) -> Iterator[pa.RecordBatch]:
        k, d = np.concatenate(keys), np.concatenate(ids)
        order = np.lexsort((d, k))
        k, d = k[order], d[order]
        new = np.append(True, k[1:] != k[:-1])[: len(k)]
        several = k[1:][~new[1:] & (d[1:] != d[:-1])]
        if len(k):
            yield from _segments(np.unique(_positions(k[new], bits)), np.unique(_positions(several, bits)))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, np.ndarray] = {}
        for b in batches:
            for s, once, twice in zip(*(c.to_pylist() for c in b.columns), strict=True):
                have = seen.setdefault(s, np.zeros(_SEGMENT, np.uint8))
                o, w = np.frombuffer(once, "<u2"), np.frombuffer(twice, "<u2")
                have[o] = np.minimum(have[o] + 1, 2)
                have[w] = 2
        for s, have in seen.items():
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int64()), pa.array([np.packbits(have == 2, bitorder="little").tobytes()], pa.binary())], ["segment", "bits"])

    parts = docs.select(key, text, F.xxhash64(key)).mapInArrow(scan, "segment long, once binary, twice binary")
    # a segment has a task's positions at most once: no segment is larger than the others
    merged = parts.repartition(F.col("segment")).mapInArrow(merge, "segment long, bits binary").collect()  # `bits` bits in all
    out = np.zeros(bits // 8, np.uint8)
    for r in merged:
        out[r["segment"] * _SEGMENT // 8 :][: _SEGMENT // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def _suspect(have: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = _positions(hashes, len(have) * 8)
    return ((have[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(0)


def _digests(t: Text, lo: np.ndarray, hi: np.ndarray) -> list[bytes]:
    data = t.data.tobytes()
    return [hashlib.blake2b(data[a:b].lower(), digest_size=16).digest() for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]


def repeated_keys(docs: DataFrame, key: str, text: str, min_chars: int, min_docs: int, shared) -> DataFrame:
    """digest and keeper of each key that ``min_docs`` documents hold. ``shared``: the
    broadcast second filter."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(b.column(0).is_valid())
            for i, _, t in slices(b.column(1)):
                line, lo, hi, h = _keys(t, min_chars)
                of = owners(t.lines[2])[line]
                # once for each document
                _, first = np.unique(mix(h + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
                first = first[_suspect(shared.value, h[first])]
                yield pa.RecordBatch.from_arrays([pa.array(_digests(t, lo[first], hi[first]), pa.binary()), b.column(0).take(pa.array(i + of[first]))], ["digest", "doc"])

    pairs = docs.select(key, text).mapInArrow(scan, f"digest binary, doc {docs.schema[key].dataType.simpleString()}").groupBy("digest", "doc").agg(F.lit(1).alias("one"))
    return pairs.groupBy("digest").agg(F.count("*").alias("n"), F.max("doc").alias("keeper")).where(F.col("n") >= min_docs).select("digest", "keeper")


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, max_bits: int = 1 << 27, max_keys: int = 1 << 18) -> DataFrame:
    """``docs`` with the text that is left, and two more columns, line_count (before) and
    line_drops. (Input columns of these names are replaced.)"""
    spark = docs.sparkSession
    docs = in_batches(docs.drop("line_count", "line_drops"))
    names, at_key, at_text = docs.columns, docs.columns.index(key), docs.columns.index(text)
    size = docs.select(F.sum(F.length(text)).alias("n")).first()["n"] or 0
    bits = _SEGMENT
    while bits < max_bits and bits < size // 8:
        bits *= 2
    shared = spark.sparkContext.broadcast(twice_filter(docs, key, text, min_chars, bits))
    confirmed = stage(repeated_keys(docs, key, text, min_chars, min_docs, shared), "repeated-lines")
    small = confirmed.count() <= max_keys
    held = spark.sparkContext.broadcast({bytes(r["digest"]): r["keeper"] for r in confirmed.toLocalIterator()}) if small else None

    def suspects(t: Text) -> tuple[np.ndarray, list[bytes]]:
        line, lo, hi, h = _keys(t, min_chars)
        s = _suspect(shared.value, h)
        return line[s], _digests(t, lo[s], hi[s])

    def finish(t: Text, dropped: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        starts, ends, first = t.lines
        gone = np.add.reduceat(np.append(dropped, False), first[:-1], dtype=np.int64) if t.n else np.zeros(0, np.int64)
        out = []
        for i in range(t.n):
            if not gone[i]:
                out.append(t.bytes(i))
            else:
                out.append(b"\n".join(t.data[starts[j] : ends[j]].tobytes() for j in range(first[i], first[i + 1]) if not dropped[j]))
        return out, np.diff(first), gone

    def emit(b: pa.RecordBatch, texts: list, n: np.ndarray, gone: np.ndarray) -> pa.RecordBatch:
        kept = pc.if_else(b.column(at_text).is_valid(), pa.array(texts, pa.binary()).cast(pa.string()), pa.scalar(None, pa.string()))
        columns = [kept if i == at_text else c for i, c in enumerate(b.columns[: len(names)])]
        columns += [pa.array(x, pa.int64()) for x in (n, gone)]
        return pa.RecordBatch.from_arrays(columns, [*names, "line_count", "line_drops"])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keeper = held.value
        for b, t in (x for whole in batches for x in pieces(whole, at_text)):
            doc = b.column(at_key).to_pylist()
            line, digests = suspects(t)
            of = owners(t.lines[2])
            dropped = np.zeros(len(of), bool)
            for j, d in zip(line.tolist(), digests, strict=True):
                keep, here = keeper.get(d), doc[of[j]]
                dropped[j] = keep is not None and here is not None and keep != here
            yield emit(b, *finish(t, dropped))

    schema = StructType([*docs.schema.fields, StructField("line_count", LongType()), StructField("line_drops", LongType())])
    if small:
        return docs.mapInArrow(apply, schema)

    # More keys than a task may hold: the suspects look theirs up in a join, and the lines to
    # drop come back to the rows, by key and digest of the text, in a second join.
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, t in (x for whole in batches for x in pieces(whole.filter(whole.column(0).is_valid()), 1)):
            line, digests = suspects(t)
            of, first = owners(t.lines[2])[line], t.lines[2]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(of)), pa.array([t_hash(t, x) for x in of], pa.binary()), pa.array(line - first[of], pa.int64()), pa.array(digests, pa.binary())], ["doc", "of", "line", "digest"])

    def t_hash(t: Text, i: int) -> bytes:
        return hashlib.blake2b(t.bytes(i), digest_size=16).digest()

    def fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, t in (x for whole in batches for x in pieces(whole, at_text)):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([t_hash(t, i) for i in range(t.n)], pa.binary())], [*names, line_of])

    def apply_listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, t in (x for whole in batches for x in pieces(whole, at_text)):
            dropped = np.zeros(t.lines[2][-1], bool)
            for x, lines in enumerate(b.column(len(names)).to_pylist()):
                dropped[t.lines[2][x] + np.array(lines or [], np.int64)] = True
            yield emit(b, *finish(t, dropped))

    line_of, line_at, line_set, doc = (free_name(names, x) for x in ("line_of", "line_at", "line_set", "line_doc"))
    hits = docs.select(key, text).mapInArrow(listed, f"doc {docs.schema[key].dataType.simpleString()}, of binary, line long, digest binary")
    drops = hits.join(confirmed, "digest").where("keeper <> doc").groupBy(F.col("doc").alias(doc), F.col("of").alias(line_at)).agg(F.collect_set("line").alias(line_set))
    marked = docs.mapInArrow(fingerprint, StructType([*docs.schema.fields, StructField(line_of, BinaryType())]))
    joined = marked.join(drops, (F.col(key) == F.col(doc)) & (F.col(line_of) == F.col(line_at)), "left")
    return joined.select(*names, line_set).mapInArrow(apply_listed, schema)

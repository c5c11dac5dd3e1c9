"""Jaccard self-join of documents on word n-grams, by parity sketches.

A document's set holds the 64-bit hashes of its distinct shingles. In a size band, the set
is XORed into a sketch of m words of 64 bits: each shingle changes the one word that its
hash names. A shingle that only one of two sets holds changes one word, so the number of
words in which two sketches differ (their Hamming distance) is at most the size of the
symmetric difference, which the similarity bounds by d in the band. With m >= d + t words,
two linked documents agree in t words (pigeonhole); words in which no shingle fell say
nothing and are left out as long as t others must agree, else they take part. So linked
documents meet in t buckets of equal (band, place, word).

Buckets are never expanded into pairs. Equal sets are one class from the start. A task
combines what it holds before anything is shuffled: of a bucket with several of its classes
one, the pivot, goes on, and the others are noted as its star; in the shuffle the pivots of
all tasks meet, packed into arrays, and form a star again. So a bucket of any size costs
one row for each member, and one for each task where it meets. Classes with fewer than t
buckets then have no partner, and of the others' buckets the t - 1 largest are not needed:
documents that only share a passage fall out here, however many they are.

In each bucket that is left, all classes are compared to one, by one-bit parity sketches
first (their Hamming distance bounds the difference too) and then by the whole sets, and
links form components. Where a bucket still has members of several components, these are
compared by their parity sketches, in blocks of bounded size: the members outside of the
largest component with each other and with those in it, never those within it. Similar
classes share many buckets: each class names ``OWNERS`` of its largest, and a pair is left to
the first one that both name (all its buckets have it if there is none). The candidates,
nearest first and few for each two components, at first as many as make them a tree, are
verified, and what fails brings on the next ones, until components are one or no pair is
left. So no link between different texts is lost, up to collisions of 64-bit hashes.

What remains quadratic is the comparison of sketches in a bucket in which many documents
agree in t words and more and yet are not linked; its rows are those outside of the largest
component times the blocks of the bucket.

Texts are scanned, never shuffled: once for sizes and parity sketches, once for the buckets
and then for the sets to verify, those of classes with a near partner, which are found by a
Bloom filter of at most ``MAX_BITS`` (above some ten million of them it lets more sets
through; the result stays the same).

Defined results: a null text or one without words has the empty set, and is linked with
nothing; a text of fewer words than a shingle is one shingle; equal rows are linked; very
long texts are taken whole; other columns are not looked at, whatever their names; keys may
be of any type that has an order, a null key is after all others; an empty table gives an
empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import bloom
from .components import components
from .scan import Text, in_batches, mix, pieces, slices, windows
from .staging import free_name, stage, temporary

RATIO = 1.5  # of a band's ends
BLOCK = 1024  # members of a bucket that are compared to as many: a few MB of parity sketches
OWNERS = 16  # buckets that a class names
COMBINED = 1 << 19  # bucket keys that a task combines at a time
PART = 1 << 20  # bucket keys that meet in a task
MAX_BITS = 1 << 27
_U = np.uint64


def sets(t: Text, k: int) -> Iterator[np.ndarray]:
    """Each text's sorted distinct shingle hashes."""
    starts, ends, first = t.words
    words = t.hashes(t.lower_sums, starts, ends)
    h, _, runs = windows(words, first, k)
    for i in range(t.n):
        if runs[i + 1] > runs[i]:
            x = np.sort(h[runs[i] : runs[i + 1]])
            yield x[np.append(True, x[1:] != x[:-1])]
        elif first[i + 1] > first[i]:
            x = words[first[i] : first[i + 1]]
            yield windows(x, np.array([0, len(x)]), len(x))[0] + _U(len(x))
        else:
            yield np.zeros(0, _U)


def fingerprint(s: np.ndarray) -> np.int64:
    return mix(s ^ _U(0xD1B54A32D192ED03)).sum(dtype=_U).astype(np.int64)


@dataclass(frozen=True)
class Band:
    low: int
    high: int  # one past
    widest: int  # the largest set that can link with one of the band
    d: int
    t: int  # words in which two linked sets agree at least
    m: int


def bands(percent: int, up_to: int) -> list[Band]:
    out, low = [], 1
    while low <= up_to:
        high = max(low + 1, int(low * RATIO))
        widest = (high - 1) * 100 // percent
        d = (100 - percent) * (high - 1 + widest) // (100 + percent)
        t = 1 + d // 8
        m = d + t
        while m - d - t < 1.5 * m * np.exp(-low / m) and m < 2 * d + t + 1:
            m += 1
        out.append(Band(low, high, widest, d, t, m))
        low = high
    return out


def bucket_keys(s: np.ndarray, all_bands: list[Band]) -> np.ndarray:
    """Of each band in which the set can have a partner, its sketch's words with their places.
    The lowest six bits are the band."""
    out = []
    for i, b in enumerate(all_bands):
        if not (b.low <= len(s) <= b.widest) or not b.d:  # no difference allowed: an equal set
            continue
        place = ((s >> _U(32)) * _U(b.m)) >> _U(32)
        run = np.flatnonzero(np.append(True, place[1:] != place[:-1]))  # the set is sorted, so are the places
        word = np.bitwise_xor.reduceat(mix(s + _U(0x9E3779B97F4A7C15)), run)
        at = place[run]
        if b.m - len(at) > b.m - b.d - b.t:  # of so many empty words too few others need agree
            none = np.setdiff1d(np.arange(b.m, dtype=_U), at)
            at, word = np.append(at, none), np.append(word, np.zeros(len(none), _U))
        out.append(mix(mix(word) + mix(at + _U(i << 32))) & ~_U(63) | _U(i))
    return np.concatenate(out) if out else np.zeros(0, _U)


def parity(s: np.ndarray) -> bytes:
    """One bit for the parity of the shingles of each hash class; 64 bits at least and two to
    four for each shingle. The halves of a sketch XORed make the next smaller one."""
    bits = 64
    while bits < 2 * len(s):
        bits *= 2
    return np.packbits(np.bincount((s & _U(bits - 1)).astype(np.int64), minlength=bits) & 1 != 0).tobytes()


def _folded(x: np.ndarray, size: int) -> np.ndarray:
    """Positions are the low bits of a hash: folding halves keeps them apart by the lower bits."""
    while len(x) > size:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x


def apart(a: bytes, b: bytes) -> int:
    """The sketches' Hamming distance, at most the size of the symmetric difference."""
    size = min(len(a), len(b))
    return int(np.bitwise_count(_folded(np.frombuffer(a, np.uint8), size) ^ _folded(np.frombuffer(b, np.uint8), size)).sum())


def near(a: bytes, b: bytes, most: int) -> bool:
    """Whether the sketches' Hamming distance allows a difference of at most ``most``."""
    return apart(a, b) <= most


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _scan(docs: DataFrame, key: str | None, text: str, k: int, rows, schema: str) -> DataFrame:
    """``rows(ids, sets)`` of all documents of a partition, as columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from rows(b.column(0), (s for _, _, t in slices(b.column(b.num_columns - 1)) for s in sets(t, k)))

    return in_batches(docs.select(*([key] if key else []), text)).mapInArrow(run, schema)


def classes(docs: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """key, size, class (the set's fingerprint) and parity sketch of each document."""

    def rows(ids: pa.Array, all_sets: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        got = [(len(s), fingerprint(s), parity(s)) for s in all_sets]
        size, of, bits = zip(*got, strict=True) if got else ((), (), ())
        yield pa.RecordBatch.from_arrays([ids, pa.array(size, pa.int64()), pa.array(of, pa.int64()), pa.array(bits, pa.binary())], ["key", "size", "class", "parity"])

    return _scan(docs, key, text, k, rows, f"key {docs.schema[key].dataType.simpleString()}, size long, class long, parity binary")


_PACKED = "part int, star boolean, buckets binary, pivots binary, classes binary"
_STARS = "bucket long, a long, b long"


def _grouped(buckets: np.ndarray, who: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each bucket and its least ``who``; and of the others, the number of the bucket, and who."""
    order = np.argsort(buckets)
    buckets, who = buckets[order], who[order]
    start = np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1])[: len(buckets)])
    least = np.minimum.reduceat(who, start) if len(start) else who
    number = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(buckets))))
    other = who != least[number]
    return buckets[start], least, number[other], who[other]


def stars(docs: DataFrame, text: str, k: int, all_bands: list[Band], keys: int) -> DataFrame:
    """bucket, a and b: of each bucket of several classes a tree of pairs of them, made of
    stars. ``keys``: about the number of rows before anything is combined."""
    tasks = max(1, -(-keys // PART))
    shift = 64 - max(1, (4 * tasks - 1).bit_length())  # the parts of a bucket's hash

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        ids: list[int] = []
        seen: set[int] = set()
        n = turn = 0
        for b in batches:
            for _, _, t in slices(b.column(0)):
                for s in sets(t, k):
                    f = int(fingerprint(s))
                    if f in seen:  # equal sets that come together
                        continue
                    seen.add(f)
                    x = bucket_keys(s, all_bands)
                    held.append(x)
                    ids.append(f)
                    n += len(x)
                    if n > COMBINED:
                        yield packed(held, ids, turn)
                        held, ids, seen, n, turn = [], [], set(), 0, turn + 1
        if n:
            yield packed(held, ids, turn)

    def packed(held: list[np.ndarray], ids: list[int], turn: int) -> pa.RecordBatch:
        of = np.array(ids, np.int64)
        # each time another class is the least, so that none is the pivot of very many
        dice = mix(of.view(_U) + _U(ids[0] & 0xFFFFFFFF) + _U(turn))
        order = np.argsort(dice)
        rank = np.empty(len(of), np.int64)
        rank[order] = np.arange(len(of))
        buckets, pivots, number, others = _grouped(np.concatenate(held), np.repeat(rank, [len(x) for x in held]))
        pivots, others = of[order][pivots], of[order][others]
        part = (buckets >> _U(shift)).astype(np.int64)
        found = np.unique(part)
        cut = np.searchsorted(part, np.append(found, found[-1:] + 1))
        out = [(int(p), False, buckets[i:j].tobytes(), b"", pivots[i:j].tobytes()) for p, i, j in zip(found, cut, cut[1:], strict=False)]
        for i in range(0, len(others), 1 << 14):  # any part will do
            at = number[i : i + (1 << 14)]
            out.append((int(dice[(i >> 14) % len(dice)] >> _U(shift)), True, buckets[at].tobytes(), pivots[at].tobytes(), others[i : i + (1 << 14)].tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), (pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()), strict=True)], ["part", "star", "buckets", "pivots", "classes"])

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for b in batches:
            for p, star, *blobs in zip(*(c.to_pylist() for c in b.columns), strict=True):
                buckets, pivots, of = (np.frombuffer(x, np.int64) for x in blobs)
                if star:
                    yield rows(buckets, pivots, of)
                else:
                    parts.setdefault(p, []).append((buckets, of))
        for p in list(parts):
            got = parts.pop(p)
            bucket, of = (np.concatenate([x[i] for x in got]) for i in (0, 1))
            buckets, pivots, number, others = _grouped(bucket, of)
            yield rows(buckets[number], pivots[number], others)

    def rows(*columns: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["bucket", "a", "b"])

    return in_batches(docs.select(text)).mapInArrow(combined, _PACKED).repartition(tasks, "part").mapInArrow(met, _STARS)


def _several(members: DataFrame) -> DataFrame:
    """The members (bucket, class, ...) of buckets of two classes and more."""
    return members.join(members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket"), "bucket", "left_semi")


def sharing(tree: DataFrame, all_bands: list[Band]) -> DataFrame:
    """bucket and class of the classes that can have a partner: two that are linked are both
    in t buckets of a band, so a class needs t of them, and without its t - 1 largest ones
    the two still meet."""
    least = F.element_at(F.array(*[F.lit(b.t) for b in all_bands] or [F.lit(1)]), (F.col("band") + 1).cast("int"))
    both = tree.select("bucket", F.col("a").alias("class")).unionByName(tree.select("bucket", F.col("b").alias("class")))
    members = stage(both.distinct(), "members").withColumn("band", F.col("bucket").bitwiseAND(F.lit(63).cast("long")))
    of_class = Window.partitionBy("class", "band")  # as many rows as a sketch has words at most
    ranked = members.join(members.groupBy("bucket").agg(F.count("*").alias("n")), "bucket")
    ranked = ranked.select("bucket", "class", "band", F.row_number().over(of_class.orderBy("n", "bucket")).alias("rank"), F.count("*").over(of_class).alias("all"))
    fewer = stage(ranked.where(F.col("rank") <= F.col("all") - least + 1).select("bucket", "class"), "members")
    return stage(_several(fewer), "members")


class Sets:
    """The sets of classes, scanned from the texts when they are first asked for."""

    def __init__(self, docs: DataFrame, text: str, k: int):
        self.docs, self.text, self.k = docs, text, k
        self.held: DataFrame | None = None

    def of(self, pairs: DataFrame) -> DataFrame:
        spark = self.docs.sparkSession
        wanted = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
        if self.held is not None:
            wanted = wanted.join(self.held, "class", "left_anti")
        wanted = stage(wanted, "wanted")
        n = wanted.count()
        if n or self.held is None:
            bits = spark.sparkContext.broadcast(bloom.build(wanted, "class", bloom.size_for(n, MAX_BITS)))
            found = _sets_of(self.docs, self.text, self.k, bits)
            found = stage(found if self.held is None else found.join(self.held, "class", "left_anti"), "sets")
            bits.destroy()
            self.held = found if self.held is None else self.held.unionByName(found)
        return self.held


def _sets_of(docs: DataFrame, text: str, k: int, wanted) -> DataFrame:
    """class and set of the classes in the filter ``wanted``, one row each."""

    def rows(_: pa.Array, all_sets: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        found: dict[int, bytes] = {}
        held = 0
        for s in all_sets:
            f = int(fingerprint(s))
            if len(s) and f not in found and bloom.contains(wanted.value, np.array([f]).view(_U))[0]:
                found[f] = s.tobytes()
                held += len(found[f])
                if held > 1 << 22:
                    yield batch(found)
                    found, held = {}, 0
        yield batch(found)

    def batch(found: dict[int, bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.binary())], ["class", "hashes"])

    return _scan(docs, None, text, k, rows, "class long, hashes binary").dropDuplicates(["class"])


def _both(pairs: DataFrame, of: DataFrame) -> DataFrame:
    """The pairs (a, b) with the other columns of ``of`` (class, ...) for each."""
    for x in ("a", "b"):
        pairs = pairs.join(of.select(*[F.col(c).alias(x if c == "class" else f"{c}_{x}") for c in of.columns]), x)
    return pairs


def _near(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and parity sketches allow to be linked, and their distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = np.array([apart(x, y) for x, y in zip(b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True)], np.int64)
            ok = d <= b.column(2).to_numpy() * (100 - percent) // (100 + percent)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(d)], ["a", "b", "apart"]).filter(pa.array(ok, pa.bool_()))

    sized = _both(pairs, sketches).where(f"100 * least(size_a, size_b) >= {percent} * greatest(size_a, size_b)")
    return sized.select("a", "b", (F.col("size_a") + F.col("size_b")).alias("sizes"), "parity_a", "parity_b").mapInArrow(run, "a long, b long, apart long")


def _verified(pairs: DataFrame, sets_of: Sets, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [linked(np.frombuffer(x, _U), np.frombuffer(y, _U), percent) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield b.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    both = _both(pairs.select("a", "b"), sets_of.of(pairs)).select("a", "b", "hashes_a", "hashes_b")
    return stage(both.mapInArrow(run, "a long, b long"), "linked")


def _rooted(rows: DataFrame, roots: DataFrame, column: str, name: str) -> DataFrame:
    r = roots.select(F.col("node").alias(column), F.col("root").alias("found_root"))
    return rows.join(r, column, "left").withColumn(name, F.coalesce("found_root", column)).drop("found_root")


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` after more links between classes."""
    if links.isEmpty():
        return roots
    up = roots.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    return components(up.unionByName(links.select("a", "b")))


def _mixed(members: DataFrame, roots: DataFrame) -> DataFrame:
    """bucket, class, root, and of the bucket: n members, ``main`` (the root that most of them
    have) and its number ``most``; for buckets whose members have several roots."""
    rooted = _rooted(members.select("bucket", "class"), roots, "class", "root")
    by_root = rooted.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    about = by_root.groupBy("bucket").agg(F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("top"), F.count("*").alias("roots")).where("roots > 1")
    return rooted.join(about.select("bucket", "n", F.col("top.root").alias("main"), F.col("top.n").alias("most")), "bucket")


def _owned(bucket: int, mine: np.ndarray, theirs: np.ndarray) -> np.ndarray:
    """Whether the pairs of a class that names ``mine`` and others that name ``theirs`` (a row
    each, in the order of ``mine``; what is not a bucket is equal to none) are the bucket's."""
    common = (theirs[:, None, :] == mine[None, :, None]).any(2)
    return ~common.any(1) | (mine[common.argmax(1)] == bucket)


def candidates(of: np.ndarray, root: np.ndarray, size: np.ndarray, sketches: list[bytes], side: np.ndarray, percent: int, quota: int, bucket: int = 0, named: list[list[int]] | None = None) -> tuple[list[tuple[int, int]], bool]:
    """The bucket's own pairs of classes with different roots that could be linked, nearest
    first: of two components ``quota`` pairs at most, which then count as one; and whether
    others were left out. Members of side 1 meet those of side 0 only; side 2 meets all."""
    # no bucket has 62 or 63 in its lowest bits, for there are fewer bands
    mine, theirs = (np.array([[*x, *[none] * (OWNERS - len(x))] for x in named or [[]] * len(of)], np.int64) for none in (-1, -2))
    root = np.unique(root, return_inverse=True)[1]
    shortest = min(map(len, sketches))
    bits = np.array([_folded(np.frombuffer(p, np.uint8), shortest) for p in sketches]).view(_U)  # eight bytes at least
    passed = [np.zeros((3, 0), np.int64)]
    for i in np.flatnonzero(side != 1):
        a, b = np.minimum(size[i], size), np.maximum(size[i], size)
        may = (root != root[i]) & (100 * a >= percent * b)
        may &= (side == 1) if side[i] == 0 else (np.arange(len(of)) > i) | (side == 1)
        j = np.flatnonzero(may)
        if len(j):
            d = np.bitwise_count(bits[j] ^ bits[i]).sum(1, dtype=np.int64)
            j, d = j[ok := d <= (100 - percent) * (a + b)[j] // (100 + percent)], d[ok]
            j, d = j[ok := _owned(bucket, mine[i], theirs[j])], d[ok]
            passed.append(np.stack([d, np.full(len(j), i), j]))
    nearest = np.concatenate(passed, axis=1)
    nearest = nearest[1:, np.lexsort((nearest[2], nearest[1], nearest[0]))]
    up: dict[int, int] = {}
    given: dict[tuple[int, int], int] = {}

    def top(r: int) -> int:
        while r in up:
            r = up[r]
        return r

    found, more = [], False
    for i, j in zip(*nearest.tolist(), strict=True):
        x, y = sorted((top(int(root[i])), top(int(root[j]))))
        if x == y:
            more = True
            continue
        one, two = int(of[i]), int(of[j])
        found.append((min(one, two), max(one, two)))
        given[x, y] = given.get((x, y), 0) + 1
        if given[x, y] >= quota:
            up[x] = y
    return found, more


def _meetings(mixed: DataFrame, sketches: DataFrame, percent: int, quota: int) -> DataFrame:
    """bucket, candidate pairs (a, b) of members of one bucket with different roots, and more,
    whether pairs were left out. Large buckets are cut into blocks: the members outside of
    the main component meet each other and those within it, block by block."""
    blocks = F.when(F.col("n") <= BLOCK, 0)
    cut = mixed.withColumns({"outer": F.coalesce(blocks, F.ceil((F.col("n") - F.col("most")) / BLOCK)).cast("long"), "inner": F.coalesce(blocks, F.ceil(F.col("most") / BLOCK)).cast("long"), "is_main": F.col("root") == F.col("main")})
    own = lambda n: F.expr(f"pmod(xxhash64(class), {n})")
    place = lambda kind, i, j, side: F.struct(F.lit(kind).alias("kind"), i.cast("long").alias("i"), j.cast("long").alias("j"), side.cast("int").alias("side"))
    with_outer = F.transform(F.expr("sequence(0L, outer - 1)"), lambda o: place(1, F.least(own("outer"), o), F.greatest(own("outer"), o), F.lit(2)))
    with_inner = F.transform(F.expr("sequence(0L, inner - 1)"), lambda o: place(2, own("outer"), o, F.lit(0)))
    from_main = F.transform(F.expr("sequence(0L, outer - 1)"), lambda o: place(2, o, own("inner"), F.lit(1)))
    places = F.when(F.col("outer") == 0, F.array(place(0, F.lit(0), F.lit(0), F.lit(2)))).when(F.col("is_main"), from_main).otherwise(F.concat(with_outer, with_inner))
    dealt = cut.join(sketches, "class").select("bucket", F.explode(places).alias("p"), "class", "root", "size", "parity", "named").select("bucket", "p.*", "class", "root", "size", "parity", "named")
    group = ["bucket", "kind", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        at = None
        for b in batches:
            lists = [b.column(i).to_pylist() for i in range(10)]
            for row in zip(*lists, strict=True):
                if row[:4] != at:
                    yield from found(at, held)
                    at, held = row[:4], []
                held.append(row[4:])
        yield from found(at, held)

    def found(at: tuple, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        if len(held) < 2:
            return
        side, of, root, size, bits, named = zip(*held, strict=True)
        pairs, more = candidates(*(np.array(x, np.int64) for x in (of, root, size)), list(bits), np.array(side), percent, quota, at[0], list(named))
        if pairs:
            yield pa.RecordBatch.from_arrays([pa.array([at[0]] * len(pairs), pa.int64()), *(pa.array([x[k] for x in pairs], pa.int64()) for k in (0, 1)), pa.array([more] * len(pairs))], ["bucket", "a", "b", "more"])

    packed = dealt.select(*group, "side", "class", "root", "size", "parity", "named").repartition(*group).sortWithinPartitions(*group, "class")
    return packed.mapInArrow(run, "bucket long, a long, b long, more boolean")


def _resolved(members: DataFrame, roots: DataFrame, sketches: DataFrame, tested: DataFrame, sets_of: Sets, percent: int) -> DataFrame:
    """``roots`` after all links within the buckets. ``tested``: pairs that need no more test."""
    members = stage(_mixed(members, roots), "mixed")
    # of the buckets with equal members, one
    same = members.groupBy("bucket").agg(F.first("n").alias("n"), F.expr("bit_xor(xxhash64(class))").alias("x"), F.expr("bit_xor(xxhash64(class, 7))").alias("y"))
    members = stage(members.join(same.groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket"), "bucket", "left_semi"), "members")
    # of the members that are left, so that a pair's bucket stays the same in all rounds; a
    # class has as many buckets as its sketches have words at most
    named = members.groupBy("class").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "bucket"))).alias("all"))
    named = named.select("class", F.slice("all.bucket", 1, OWNERS).alias("named"))
    sketches_named = stage(sketches.join(named, "class"), "sketches")
    quota = 1
    while not members.isEmpty():
        met = stage(_meetings(members, sketches_named, percent, quota), "met")
        pairs = stage(met.select("a", "b").distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
        good = _verified(stage(_near(pairs, sketches, percent), "near"), sets_of, percent)
        roots = _merged(roots, good)
        tested = stage(tested.unionByName(pairs), "tested")
        # a bucket of which pairs were left out for others that then failed comes again
        again = met.where("more").join(good, ["a", "b"], "left_anti").select("bucket").distinct()
        members = stage(_mixed(members.join(again, "bucket", "left_semi"), roots), "members")
        quota *= 16
    return roots


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 3, percent: int = 90) -> DataFrame:
    """Of each row: key, size (of its set), class, and root, which is equal for all rows
    that links connect (null for an empty set)."""
    spark = docs.sparkSession
    with temporary(spark):
        known = stage(classes(docs, key, text, k), "classes")
        largest = known.agg(F.max("size").alias("n")).first()["n"] or 0
        all_bands = bands(percent, largest)
        used = [b for b in all_bands if b.d]
        count = sum((F.sum(F.when(F.col("size").between(b.low, b.widest), b.m).otherwise(0)) for b in used), F.lit(0))
        keys = known.agg(count.cast("long").alias("n")).first()["n"] or 0

        tree = stage(stars(docs, text, k, all_bands, keys), "stars")
        members = sharing(tree, all_bands)
        once = known.where("size > 0").select("class", "size", "parity").dropDuplicates(["class"])
        sketches = stage(once.join(members.select("class").distinct(), "class", "left_semi"), "sketches")
        pivots = members.groupBy("bucket").agg(F.min("class").alias("pivot"))
        star = members.join(pivots, "bucket").where("class <> pivot")
        tested = stage(star.select(F.col("pivot").alias("a"), F.col("class").alias("b")).distinct(), "tested")
        close = stage(_near(tested, sketches, percent), "near")

        sets_of = Sets(docs, text, k)
        sets_of.of(close)
        first = stage(close.groupBy(F.col("b").alias("other")).agg(F.min_by("a", F.struct("apart", "a")).alias("a")).select("a", F.col("other").alias("b")), "first")
        roots = components(_verified(first, sets_of, percent))
        rest = close.join(first, ["a", "b"], "left_anti")
        rest = stage(_rooted(_rooted(rest, roots, "a", "root_a"), roots, "b", "root_b").where("root_a <> root_b").select("a", "b"), "rest")
        roots = _merged(roots, _verified(rest, sets_of, percent))
        roots = _resolved(members, roots, sketches, tested, sets_of, percent)
        out = _rooted(known.select(F.col("key").alias(key), "size", "class"), roots, "class", "root")
        out = stage(out.withColumn("root", F.when(F.col("size") > 0, F.col("root"))), "joined", keep=True)
    return out


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 3, percent: int = 90) -> DataFrame:
    """Of each row: key, size, and component, the smallest key that links reach from it."""
    found = join(docs, key, text, k, percent)
    low = found.where("root IS NOT NULL").groupBy("root").agg(F.min(key).alias("component"))
    return found.join(low, "root", "left").select(key, "size", F.coalesce("component", key).alias("component"))


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, one of each group: that of the smallest key (nulls last). Of
    rows of one key, each is judged by its own text; of rows of one key and equal sets one
    stays. Texts are moved only of rows whose key a Bloom filter suspects."""
    spark = docs.sparkSession
    names = docs.columns
    of, h, again = free_name(names, "class"), free_name(names, "hash"), free_name(names, "again")
    with temporary(spark):
        found = join(docs, key, text, k, percent).where("root IS NOT NULL")
        place = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col("class").alias("class"))
        rows = found.groupBy("root", place.alias("place")).agg((F.count("*") > 1).alias("again"))
        best = rows.groupBy("root").agg(F.min("place").alias("best"))
        marked = rows.join(best, "root").withColumn("again", F.when(F.col("place") == F.col("best"), F.when(F.col("again"), True)).otherwise(False))
        marked = marked.where("again IS NOT NULL").select(F.col("place.key").alias("marked_key"), F.col("place.class").alias("marked_class"), F.col("again").alias(again))
        marked = stage(marked, "marked", keep=True)
    hashes = marked.select(F.xxhash64("marked_key").alias("h"))
    have = spark.sparkContext.broadcast(bloom.build(hashes, "h", bloom.size_for(marked.count(), MAX_BITS)))

    at = names.index(text)

    def split(batches: Iterator[pa.RecordBatch], suspected: bool) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, _ in pieces(b, at):
                hit = bloom.contains(have.value, rows.column(len(names)).to_numpy().view(_U))
                yield rows.select(range(len(names))).filter(pa.array(hit == suspected))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return split(batches, False)

    def suspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in split(batches, True):
            ids = [fingerprint(s) for _, _, t in slices(b.column(at)) for s in sets(t, k)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ids, pa.int64())], [*names, of])

    with_hash = in_batches(docs.withColumn(h, F.xxhash64(key)))
    suspects = with_hash.mapInArrow(suspect, StructType([*docs.schema.fields, StructField(of, LongType())]))
    judged = suspects.join(marked, F.col(key).eqNullSafe(F.col("marked_key")) & (F.col(of) == F.col("marked_class")), "left")
    stay = judged.where(F.col(again).isNull()).select(names)
    repeated = judged.where(F.col(again)).groupBy(key, of).agg(F.min_by(F.struct(*names), F.xxhash64(text)).alias(h)).select(f"{h}.*")
    return with_hash.mapInArrow(clean, docs.schema).unionByName(stay).unionByName(repeated)

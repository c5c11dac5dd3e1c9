"""Spelling variants: words that differ in one character, grouped under the most frequent.

A word that differs from another in one character shares all their bigrams but those next to
the difference: two at most in either word. So if bigrams are put in one order for all words,
the rarest first, the first that both words share is among the three first of either, and it
stands at the same place in both, or one place further in the longer. Words are joined on
their three rarest bigrams with that limit on places and lengths, and each pair that meets is
verified. A word has four bigrams at least, hence one that is shared.

The order is by frequency of the bigram itself, for bigrams of different places must not
change their order when a character goes.

Defined results: null and empty texts have no words; a text or a word of any length is handled
whole; repeated rows count each; rows with a null id count as those with an empty one; an empty
table gives no words; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import nsmallest
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import LEAD, LOWER, Text, in_batches, owners, pieces, totals
from .staging import stage

TEXT_LIMIT = 1 << 22
LEAST_LENGTH = 5  # of code points; the filter needs three bigrams and one more
RAREST = 3

_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0xC3] = True


def runs(t: Text) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased, and their documents."""
    inside = _LETTER[t.data]
    inside[1:] |= t.data[:-1] == 0xC3  # the second byte of a letter beyond ASCII
    starts, ends, first = t.spans(inside)
    offs = np.append(0, np.cumsum(ends - starts)).astype(np.int64)
    letters = LOWER[t.data[inside]]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offs), pa.py_buffer(letters)]).dictionary_encode(), owners(first)


def _counted(t: Text, ids: list[str], damage: int) -> dict[bytes, int]:
    """How often the texts hold each word. With ``damage``, of a word whose crc32 with the
    document's id that number divides, one code point goes."""
    found, of = runs(t)
    words, code = found.dictionary.to_pylist(), found.indices.to_numpy()
    if not damage:
        return dict(zip(words, np.bincount(code, minlength=len(words)).tolist(), strict=True))
    both, n = np.unique(of * np.int64(len(words)) + code, return_counts=True)
    doc, code = np.divmod(both, max(len(words), 1))
    begun = [crc32(f"{x}:".encode()) for x in ids]
    h = np.fromiter((crc32(words[c], begun[d]) for d, c in zip(doc.tolist(), code.tolist(), strict=True)), np.int64, len(both))
    hurt = h % damage == 0
    out = dict(zip(words, np.bincount(code[~hurt], n[~hurt], len(words)).astype(np.int64).tolist(), strict=True))
    for c, x, k in zip(code[hurt].tolist(), h[hurt].tolist(), n[hurt].tolist(), strict=True):
        word = words[c].decode()
        at = x % len(word)
        word = (word[:at] + word[at + 1 :]).encode()
        out[word] = out.get(word, 0) + k
    return out


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", damage: int = 0, least: int = 3) -> DataFrame:
    """word and n of the words of LEAST_LENGTH code points and more that occur ``least`` times
    or more. ``damage``: see ``_counted``; 0 leaves all words as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, t in pieces(b, 1, TEXT_LIMIT):
                counted = _counted(t, [x or "" for x in rows.column(0).to_pylist()], damage)
                words = pa.array(counted.keys(), pa.binary())
                n = np.fromiter(counted.values(), np.int64, len(counted))
                offs = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1)
                long = totals(LEAD[np.frombuffer(words.buffers()[2] or b"", np.uint8)[: offs[-1]]], offs) >= LEAST_LENGTH
                keep = pa.array(long & (n > 0))
                yield pa.RecordBatch.from_arrays([words.filter(keep).cast(pa.string()), pa.array(n).filter(keep)], ["word", "n"])

    found = in_batches(docs.select(F.col(key).cast("string"), text)).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


SPLIT = 4  # characters of the side of a difference from which its halves are told apart


def _sides(word: str, at: int, shift: int) -> Iterator[tuple[int, str, str, int]]:
    """What a near word must share with ``word`` when both have the bigram at ``at``: the
    difference is on one side of it, so the other is the same, and so is one half of a side
    of SPLIT characters. ``shift`` 1: the other word is longer by one character. Each with the
    bigram's place in the longer word and a number for the part that is free."""
    n, end = len(word), at + 2
    left, right = at + shift, n - end + shift  # characters of the longer word's sides
    if left:
        half = left // 2
        for part, same in ((0, ""),) if left < SPLIT else ((1, word[:half]), (2, word[at - (left - half) : at])):
            yield part, same, word[at:], left
    if right:
        half = right // 2
        for part, same in ((3, ""),) if right < SPLIT else ((4, word[end : end + half]), (5, word[n - (right - half) :])):
            yield part, word[:end], same, at


def meeting_keys(word: str, grams: list[int], shift: int) -> list[int]:
    """Hashes of the bigrams at the places ``grams``, with what ``_sides`` tells of them."""
    out = []
    for at in grams:
        for part, a, b, place in _sides(word, at, shift):
            h = crc32(f"{len(word) + shift}.{place}.{part}.{len(a)}".encode())
            out.append(crc32(a.encode(), h) << 31 | crc32(b.encode(), h) & 0x7FFFFFFF)
    return out


def near_pairs(words: DataFrame) -> DataFrame:
    """a, a_n, b, b_n, once for each two words (word, n) that one inserted, deleted or replaced
    code point tells apart, in either order."""
    spark = words.sparkSession
    gram = F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", i, F.lit(2)))).alias("gram")
    counted = words.where(F.length("word") >= LEAST_LENGTH).select(gram).groupBy("gram").count().collect()  # an alphabet squared, some 8000 rows at most
    order = {r["gram"]: i for i, r in enumerate(sorted(counted, key=lambda r: (r["count"], r["gram"])))}
    shared = spark.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared.value
        for b in batches:
            keys, ofs, longer = [], [], []
            for i, word in enumerate(b.column(0).to_pylist()):
                places = nsmallest(RAREST, range(len(word) - 1), key=lambda j, w=word: (order[w[j : j + 2]], j))
                for shift in (0, 1):
                    found = set(meeting_keys(word, places, shift))
                    keys += found
                    ofs += [i] * len(found)
                    longer += [shift == 1] * len(found)
            rows = b.take(pa.array(ofs, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(longer, pa.bool_()), *rows.columns], ["key", "longer", "word", "n"])

    keyed = in_batches(words.where(F.length("word") >= LEAST_LENGTH).select("word", "n")).mapInArrow(run, "key long, longer boolean, word string, n long")
    keyed = stage(keyed, "spelling-keys")
    a, b = keyed.alias("a"), keyed.where("NOT longer").alias("b")
    meets = (F.col("a.key") == F.col("b.key")) & (F.col("a.longer") | (F.col("a.word") < F.col("b.word"))) & (F.levenshtein("a.word", "b.word", 1) == 1)
    return a.join(b, meets).select(F.col("a.word").alias("a"), F.col("a.n").alias("a_n"), F.col("b.word").alias("b"), F.col("b.n").alias("b_n")).distinct()


def group(words: DataFrame, factor: int = 2) -> DataFrame:
    """Of each word (word, n): word, form, root, n, n_near, form_n.

    ``form`` is its near word of largest n, of equal ones the smallest, if that n is
    ``factor`` times its own at least, else null; ``root`` is where the forms end, for n grows
    from form to form."""
    pairs = stage(near_pairs(words), "spelling-pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("a").alias("b"), F.col("a_n").alias("b_n")))
    near = both.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("form"))).alias("best"))
    fits = -F.col("best.less") >= factor * F.col("n")
    out = words.select("word", "n").join(near, "word", "left")
    out = stage(out.select("word", F.when(fits, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(fits, -F.col("best.less")).alias("form_n")), "spelling-forms")
    roots = out.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:  # each round doubles the way that roots have come; n doubles with every step of it
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        went = stage(roots.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        roots = went.select("word", "root")
        if went.where("moved").isEmpty():
            break
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

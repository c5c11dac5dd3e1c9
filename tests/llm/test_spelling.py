"""Spelling groups against all pairs of words."""

import collections
import random
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from quillon.llm import entry, spelling


def near(a, b):
    """Exactly one insertion, deletion or replacement apart."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def counted(rows, damage):
    n = collections.Counter()
    for key, text in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), word)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if damage and h % damage == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            n[word] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def grouped(n):
    form, many = {}, {}
    for w in n:
        others = [x for x in n if near(w, x)]
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if others and n[best] >= 2 * n[w] else None
        many[w] = len(others)
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (w, form[w], root, n[w], many[w], n[form[w]] if form[w] else None)
    return out


def check(spark, n):
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    assert {r["word"]: tuple(r) for r in spelling.group(words).collect()} == grouped(n)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="abcé", min_size=5, max_size=14), st.integers(0, 13), st.sampled_from("abcdé"), st.sampled_from("ird"))
def test_near_words_meet(word, at, letter, kind):
    """Whatever the order of the bigrams, near words of five letters share a key."""
    at = min(at, len(word) - 1)
    other = word[:at] + {"i": letter + word[at:], "r": letter + word[at + 1 :], "d": word[at + 1 :]}[kind]
    if other == word or len(other) < 5:
        return
    assert near(word, other)
    order = {}
    for w in sorted({w[i : i + 2] for w in (word, other) for i in range(len(w) - 1)}, key=lambda g: zlib.crc32(g.encode())):
        order[w] = len(order)
    short, long = sorted((word, other), key=len)
    three = [sorted(range(len(w) - 1), key=lambda j, w=w: (order[w[j : j + 2]], j))[:3] for w in (short, long)]
    shift = len(long) - len(short)
    assert set(spelling.meeting_keys(short, three[0], shift)) & set(spelling.meeting_keys(long, three[1], 0))


def test_groups(spark):
    r = random.Random(5)
    n = {}
    for _ in range(60):
        word = "".join(r.choice("aebnotsé") for _ in range(r.randint(5, 12)))
        n[word] = r.randint(3, 900)
        for _ in range(6):
            i = r.randrange(len(word))
            word = r.choice([word[:i] + word[i + 1 :], word[:i] + r.choice("aeÿ") + word[i:], word[:i] + "t" + word[i + 1 :]])
            if len(word) >= 5:
                n[word] = r.choice([3, 5, 5, 40, 200])
    n |= {"a" * k: 3 * k for k in range(5, 15)} | {"chain" + "s" * k: 3 * 2**k for k in range(12)}
    n["é" * 3000] = 4
    n["é" * 2999 + "e"] = 8
    check(spark, n)


def test_no_words(spark):
    assert spelling.group(spark.createDataFrame([], "word string, n long")).collect() == []
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "word 12"), (3, "abcd " * 9)], "doc_id long, text string")
    assert spelling.count_words(docs).collect() == []


def test_counts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "TEXT_LIMIT", 60)
    r = random.Random(2)
    words = ["Straße", "straße", "ÀÉÎõü", "word's", "naïve-ish", "×times÷", "ABCDEÀ", "日本hello語", "x" * 200, "hello\nworld", "the"]
    rows = [(r.choice([None, 1, 2, 3, 10**12]), " ".join(r.choice(words) for _ in range(r.randint(0, 30)))) for _ in range(80)]
    rows += [rows[0], rows[0], (7, None), (8, "")]
    docs = spark.createDataFrame([(*x, "clash", 1) for x in rows], "doc_id long, text string, word string, n int").repartition(3)
    for damage in (0, 2, 97):
        assert dict(map(tuple, spelling.count_words(docs, damage=damage).collect())) == counted(rows, damage)


def test_op12_query(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    n = counted(rows, entry.DAMAGE)
    out = {r["word"]: tuple(r) for r in entry.QUERIES["op12_spelling_groups"](spark, sf_dir).collect()}
    assert {w: x[3] for w, x in out.items()} == n
    assert out == grouped(n)

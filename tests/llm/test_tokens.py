"""Packing and token files against the tokenizers library itself."""

import collections
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quillon.llm import entry, packing, token_files, tokens
from quillon.llm.scan import slices

WORDS, BYTES = (public_tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = ["", " ", "\n", "  a  b\n\n c\t d \n", "it's We'LL don't", "x \n b  c", "é ́a ΑΣ ΟΔΟΣ. İx", "日本語 テスト　です 🙂 x", "<|endoftext|> a<|startoftext|>b", "hello<|endoftext|>world", "x <|EndOfText|>\n<|startoftext|", "<|endoftext|>", "a\x1c\x1fb \x85 c \nd", "ªº µ ²½ 12345 1 2", "é, ×, ÷. “a”, b…, c", "ﬁ ǅ ß ẞ", "trail \n\n "]


def library(path, texts, end):
    t = Tokenizer.from_file(path)  # as the contract names it: with its defaults
    return [[*e.ids, end] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_odd_texts(path):
    assert [x.tolist() for _, x in tokens.encoded(pa.array([*ODD, None]), path, 1)] == library(path, [*ODD, None], 1)


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_strings_of_special_tokens(path):
    texts = ["hello<|endoftext|>world", "plain", "", None]
    got = [x.tolist() for _, x in tokens.encoded(pa.array(texts), path, 1)]
    assert got == library(path, texts, 1)
    special = Tokenizer.from_file(path).token_to_id("<|endoftext|>")
    assert special in got[0]
    plain, _ = tokens.Encoder(path, plain=True).encode(next(iter(slices(pa.array(texts))))[2])
    assert special not in plain


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab Zé×ñ.,'!\n\t ́ß19_日 sS")), max_size=30), max_size=5))
def test_any_text(texts):
    for path in (WORDS, BYTES):
        assert [x.tolist() for _, x in tokens.encoded(pa.array(texts, pa.string()), path, 1)] == library(path, texts, 1)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=50))
def test_variable_length_code(ranks):
    control, data = token_files.encode_ranks(np.array(ranks, np.uint32))
    assert token_files.decode_ranks(control, data, len(ranks)).tolist() == ranks


def one_by_one(lengths, capacity):
    """The number of sequences when pieces are placed one at a time."""
    lengths = sorted(lengths, reverse=True)
    large, small = [x for x in lengths if 3 * x > capacity], [x for x in lengths if 3 * x <= capacity]
    room = []
    while large:
        a = large.pop(0)
        fits = [i for i, b in enumerate(large) if a + b <= capacity]
        room.append(capacity - a - (large.pop(fits[0]) if fits else 0))
    for x in small:
        best = min((i for i, g in enumerate(room) if g >= x), key=lambda i: room[i], default=None)
        if best is None:
            room.append(capacity)
            best = len(room) - 1
        room[best] -= x
    return len(room)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 40).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=60))))
def test_plan_is_that_of_single_pieces(case):
    capacity, lengths = case
    p = packing.plan(dict(collections.Counter(lengths)), capacity)
    assert p.sequences == one_by_one(lengths, capacity)
    seen = collections.Counter()
    places = collections.defaultdict(list)
    for x in lengths:
        s, o = p.place(np.array([x]), np.array([seen[x]]))
        seen[x] += 1
        places[int(s[0])].append((int(o[0]), x))
    assert len(places) == p.sequences
    for parts in places.values():
        at = 0
        for o, x in sorted(parts):
            assert o == at
            at += x
        assert at <= capacity


def check_packing(got, texts, capacity=4096):
    want = library(WORDS, [x for _, x in texts], 1)
    pieces = collections.Counter((d, s // capacity, s, len(x[s : s + capacity]), crc(x[s : s + capacity])) for (d, _), x in zip(texts, want, strict=True) for s in range(0, len(x), capacity))
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == pieces
    places = collections.defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for o, x in sorted(parts):
            assert o == at
            at += x
        assert at <= capacity
    assert len(places) == one_by_one([r.length for r in got], capacity)


def test_packing_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in entry.table(spark, sf_dir, "documents").collect()]
    check_packing(entry.op4_packing(spark, sf_dir).collect(), docs)


@pytest.mark.parametrize("small", [0, 1 << 18])
def test_packing_of_many_parts(spark, monkeypatch, small):
    """Counts joined by shuffle and known to every task give the same places."""
    monkeypatch.setattr(packing, "SMALL", small)
    texts = [None, "", "a b c"] * 40 + [f"word{i % 5} " * (i % 9 * 100) for i in range(90)] + ["long text, " * 9000] * 2
    docs = spark.createDataFrame([(i if i % 4 else 7, t, 1, 2) for i, t in enumerate(texts)], "doc_id int, text string, part int, nth int").repartition(7, "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = packing.pack_documents(docs, WORDS, with_ids=False).collect()
    check_packing(got, rows)
    assert not {"part", "nth"} & set(got[0].__fields__)


def test_packing_odd_rows(spark):
    texts = [*enumerate(ODD), (3, None), (3, None), (None, "a b"), (9, "same text"), (9, "same text"), (50, "word " * 9000)]
    docs = spark.createDataFrame([(i, x, 7, 8) for i, x in texts], "doc_id long, text string, length int, offset int")
    check_packing(packing.pack_documents(docs, WORDS).collect(), texts)
    assert packing.pack_documents(docs.where("false"), WORDS).count() == 0
    ids = {r.doc_id: r.ids for r in packing.pack_documents(docs.where("doc_id = 0"), WORDS).collect()}
    assert ids == {0: [1]}


def check_files(got, texts):
    texts = sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, (x[1] or "").encode()))
    want, at = [], 0
    for (d, _), x in zip(texts, library(BYTES, [x for _, x in texts], 0), strict=True):
        want.append((d, at, len(x), crc(x)))
        at += len(x)
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got), key=lambda x: x[1]) == want


def test_token_file_query(spark, sf_dir):
    check_files(entry.op9_token_files(spark, sf_dir).collect(), [(r.doc_id, r.text) for r in entry.table(spark, sf_dir, "documents").collect()])


def test_token_files_odd_rows(spark, tmp_path):
    texts = [*enumerate(ODD), (3, None), (None, "a b"), (9, "same"), (9, "same"), (7, "long " * 300_000)]
    docs = spark.createDataFrame([(i, x, 7, 8) for i, x in texts], "doc_id long, text string, part int, start int")
    token_files.write(docs, f"file://{tmp_path}/a", BYTES)
    check_files(token_files.read(spark, f"file://{tmp_path}/a").collect(), texts)
    rank0 = spark.read.parquet(f"file://{tmp_path}/a/ids").where("rank = 0").first()
    assert rank0["count"] == 300_000 - 1 or rank0["count"] >= 300_000 - 1
    token_files.write(docs.where("false"), f"file://{tmp_path}/b", BYTES)
    assert token_files.read(spark, f"file://{tmp_path}/b").count() == 0

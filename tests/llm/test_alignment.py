"""Encoding by the agenda against the sentencepiece library, and alignment token by token."""

import collections
import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillon.llm import alignment, entry, piece_bpe, staging, tokens

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  ", "\n", "a", "a ", " a  b ", "\t\n  x", "▁", "a▁b ▁", "日本語テスト。 です🙂", "<s> </s> <unk> <0x41>", "a　b c", "﻿x​", "\x00\x01", "ﬁ é É", "x" * 5000, "ab" * 40 + " " * 70 + "日" * 300, "1234567890" * 20, " a b" * 3000]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_odd_texts(library):
    assert piece_bpe.encode_texts(pa.array(ODD), MODEL).to_pylist() == [library.encode(x or "") for x in ODD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(alphabet=st.sampled_from(list("abcdeo  s\n\t.,é日▁🙂1_")), max_size=60), st.text(max_size=20)), max_size=6))
def test_any_text(texts):
    texts = [x.encode("utf-8", "ignore").decode() for x in texts]
    own = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert piece_bpe.encode_texts(pa.array(texts, pa.string()), MODEL).to_pylist() == [own.encode(x) for x in texts]


def test_small_slices(library, monkeypatch):
    monkeypatch.setattr(piece_bpe, "TEXT_LIMIT", 50)
    monkeypatch.setattr(piece_bpe, "ROWS", 3)
    texts = [f"word{i % 37} other{i % 11}, more {i}" for i in range(300)]
    assert piece_bpe.encode_texts(pa.array(texts), MODEL, check=True).to_pylist() == [library.encode(x) for x in texts]


def test_a_difference_is_an_error(monkeypatch):
    e = piece_bpe.PieceEncoder(MODEL)
    e.pair_made = e.pair_made[::-1].copy()
    monkeypatch.setitem(piece_bpe._encoders, MODEL, e)
    with pytest.raises(ValueError, match="other ids"):
        piece_bpe.encode_texts(pa.array(["hello there"]), MODEL)


def test_tables(spark, library):
    rows = [(i, x, "was here") for i, x in enumerate([*ODD, "twice", "twice"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    out = piece_bpe.decode(piece_bpe.encode(docs, MODEL), MODEL)
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    for r in out.withColumn("sha", piece_bpe.ids_sha256(F.col("ids"))).collect():
        ids = library.encode(r["text"] or "")
        assert (r["ids"], r["decoded"]) == (ids, library.decode(ids))
        assert r["sha"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert piece_bpe.decode(spark.createDataFrame([(None,)], "ids array<int>"), MODEL).collect()[0]["decoded"] == ""
    assert piece_bpe.encode(docs.limit(0), MODEL).collect() == []


def test_op13_query(spark, sf_dir, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    out = entry.QUERIES["op13_sentencepiece"](spark, sf_dir).collect()
    assert len(out) == len(texts)
    for r in out:
        ids = library.encode(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


BYTE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain(library):
    """The alignment of texts and the query's columns, one token at a time."""
    tokenizer = Tokenizer.from_file(BYTE)
    tokenizer.encode_special_tokens = True
    letters = {v: k for k, v in tokens.byte_letters().items()}

    def spans(ids, each):
        at, out = 0, []
        for i in ids:
            out.append((i, at, at + len(each(i))))
            at = out[-1][2]
        return out

    def of_a(i):
        return bytes(letters[c] for c in tokenizer.id_to_token(i))

    def of_b(i):
        p = library.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if library.is_byte(i) else p.replace("▁", " ").encode()

    def one(text):
        if not text:
            return [], [], [], ""
        a, b = spans(tokenizer.encode(" " + text, add_special_tokens=False).ids, of_a), spans(library.encode(text), of_b)
        whole = (" " + text).encode()
        if any(b"".join(each(i) for i, _, _ in x) != whole for x, each in ((a, of_a), (b, of_b))):
            return [], [], [], ""
        links, k = [], 0
        for i, x, y in a:
            while b[k][2] <= x:
                k += 1
            m = k
            while m < len(b) and b[m][1] < y:
                links.append((i, b[m][0]))
                m += 1
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups = ";".join("|".join(",".join(str(i) for i, _, e in t if lo < e <= hi) for t in (a, b)) for lo, hi in zip([0, *ends], ends, strict=False)) if len(a) < 3000 else None
        return a, b, links, (groups, len(ends))

    def table(texts):
        docs = [one(t) for t in texts]
        n = collections.Counter(x for d in docs for x in set(d[2]))
        high = collections.defaultdict(int)
        for (a, _), k in n.items():
            high[a] = max(high[a], k)
        out = []
        for a, b, links, groups in docs:
            text, m = groups or ("", 0)
            sha = None if text is None else hashlib.sha256(text.encode()).hexdigest() if a else ""
            out.append((len(a), len(b), m, len(links), sum(n[x] == high[x[0]] for x in links), sum(n[x] for x in links), sha))
        return out

    return table


def same(got, want):
    for g, w in zip(got, want, strict=True):
        assert g[:6] == w[:6]
        assert w[6] in (None, g[6])


def test_alignment_of_odd_texts(spark, plain, monkeypatch):
    monkeypatch.setattr(alignment, "TEXT_LIMIT", 300)
    monkeypatch.setattr(alignment, "HELD", 64)
    texts = [*ODD, "hello<|endoftext|>world", "the the the", "the the the", "it's naïve — don't!", " 日本 the end\n\n\n"]
    docs = spark.createDataFrame([(i, x, f"q{i}", 5) for i, x in enumerate(texts)], "doc_id long, text string, pairs string, groups int").repartition(3)
    aligned = alignment.align(docs, BYTE, MODEL, keep=("doc_id", "groups"))
    assert aligned.columns == ["doc_id", "groups", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"]
    aligned = staging.stage(alignment.align(docs, BYTE, MODEL), "test-aligned")
    out = alignment.look_up(aligned, alignment.count_pairs(aligned, alignment.ids_of(BYTE))).orderBy("doc_id").collect()
    digest = [hashlib.sha256(r["groups"].encode()).hexdigest() if r["n_a"] else "" for r in out]
    same([(r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], d) for r, d in zip(out, digest, strict=True)], plain(texts))


def test_alignment_of_nothing(spark):
    for rows in ([], [(1, None), (2, "")]):
        aligned = alignment.align(spark.createDataFrame(rows, "doc_id long, text string"), BYTE, MODEL)
        out = alignment.look_up(aligned, alignment.count_pairs(aligned, alignment.ids_of(BYTE))).collect()
        assert sorted((r["doc_id"], r["n_a"], r["n_links"], r["count_sum"], r["groups"]) for r in out) == [(x, 0, 0, 0, "") for x, _ in rows]


def test_sums_across_batches():
    r = np.random.default_rng(3)
    lists = [np.sort(r.choice(50, r.integers(0, 20), False)).astype("<i8") for _ in range(200)]
    batches = [pa.record_batch([pa.array([x.tobytes() for x in lists[i : i + 7]], pa.binary())], ["pairs"]) for i in range(0, 200, 7)]
    rows = sorted((k, n) for b in alignment._partial(iter(batches)) for k, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
    parts = [pa.record_batch([pa.array([k for k, _ in rows[i : i + 3]], pa.int64()), pa.array([n for _, n in rows[i : i + 3]], pa.int64())], ["pair", "n"]) for i in range(0, len(rows), 3)]
    summed = {int(k): int(n) for ks, ns in alignment._run_lengths(iter(parts)) for k, n in zip(ks, ns, strict=True)}
    assert summed == dict(collections.Counter(int(k) for x in lists for k in x))


def test_op11_query(spark, sf_dir, plain):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    out = {r["doc_id"]: r for r in entry.QUERIES["op11_token_alignment"](spark, sf_dir).collect()}
    assert len(out) == len(docs)
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    same([tuple(out[d["doc_id"]][c] for c in columns) for d in docs], plain([d["text"] for d in docs]))

"""Token ids of whole texts at speed, equal to those of the tokenizers library.

A text is cut before white space that follows a visible character, and between a Latin
letter and ASCII punctuation; no token of the supported tokenizers crosses such a cut. Equal pieces of a slice are found by Arrow's
dictionary encoding, and only pieces that this worker has not met lately are encoded, by
the library. Its whole pipeline does so, but for pieces of plain letters, digits and
punctuation its model is called directly, as normaliser and pre-tokenizer leave no doubt
about them. A tokenizer of another make encodes whole texts.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer
from tokenizers.models import BPE

from .scan import Text, slices

TEXT_LIMIT = 1 << 22
CACHE = 1 << 26  # bytes of pieces, as Python objects, in each of two generations
_OBJECTS = 200  # bytes of a cached piece besides its own and its ids
_CUT = np.zeros(256, bool)
_CUT[[0x20, 0x0A]] = True
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = _VISIBLE[0x80:] = True

_MARK = np.zeros(256, bool)
_MARK[0x21:0x7F] = True
_MARK[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False
_ENDS = np.zeros(256, bool)
_ENDS[0x41:0x5B] = _ENDS[0x61:0x7B] = _ENDS[0x80:0xC0] = True

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = re.escape("!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")
_PLAIN = re.compile(f"[ \n]?[{_LETTERS}0-9{_MARKS}]+")
_SPACED = re.compile(f" ?[{_LETTERS}]+| ?[0-9]+| ?[{_MARKS}]+|\n")
_SINGLE = re.compile(f"[{_LETTERS}]+|[0-9]|[{_MARKS}]+")

#: Fixed value: the pattern of a tokenizer whose white space is dropped.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> dict[int, str]:
    """The visible character of each byte in byte-level vocabularies: printable Latin-1
    stands for itself, the others follow from code point 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """``plain``: strings of special tokens in a text are text like any other. By the library's
    default they are the special tokens, and a text that holds one goes to the library whole."""

    def __init__(self, path: str, plain: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        added = [] if plain else [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile(b"|".join(re.escape(x.encode()) for x in added), re.I) if added else None
        self.lead = re.match("[^A-Za-z]*", os.path.commonprefix(added))[0].encode()  # which every one begins with
        pre, norm = (json.loads(x.__getstate__()) if x else {} for x in (self.tokenizer.pre_tokenizer, self.tokenizer.normalizer))
        kinds = [x["type"] for x in norm.get("normalizers", [])]
        steps = pre.get("pretokenizers", [])
        self.lower = kinds == ["NFC", "Replace", "Lowercase"] and len(steps) == 2 and steps[0].get("pattern") == {"Regex": WORD_PATTERN} and steps[1]["type"] == "ByteLevel"
        self.spaced = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not norm
        self.fast = bool(self.lower or self.spaced) and isinstance(self.tokenizer.model, BPE)
        self.model, self.letters = self.tokenizer.model, str.maketrans(byte_letters())
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.held = 0

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        shown = word.translate(self.letters) if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _piece(self, piece: bytes) -> bytes:
        got = self.old.get(piece)
        if got is None:
            s = piece.decode()
            if not _PLAIN.fullmatch(s):
                got = self._whole(s)
            elif self.lower:
                got = b"".join([self._word(w) for w in _SINGLE.findall(s.lower())])
            else:
                got = b"".join([self._word(w) for w in _SPACED.findall(s)])
        self.held += len(piece) + len(got) + _OBJECTS
        if self.held > CACHE:
            self.old, self.new, self.held = self.new, {}, 0
        self.new[piece] = got
        return got

    def _cuts(self, t: Text) -> np.ndarray:
        d = t.data
        cut = np.zeros(len(d), bool)
        at = np.flatnonzero(_CUT[d[1:]] & _VISIBLE[d[:-1]]) + 1
        # not after white space of several bytes, nor what may be such
        last, mid, far = d[at - 1], d[np.maximum(at - 2, 0)], d[np.maximum(at - 3, 0)]
        cut[at[~((last >= 0x80) & ((mid == 0xC2) | (((mid == 0x80) | (mid == 0x81) | (mid == 0x9A)) & (far >= 0xE1) & (far <= 0xE3))))]] = True
        at = np.flatnonzero(_MARK[d[1:]] & _ENDS[d[:-1]]) + 1
        last, mid = d[at - 1], d[np.maximum(at - 2, 0)]
        cut[at[(last < 0x80) | ((mid == 0xC3) & (last != 0x97) & (last != 0xB7))]] = True
        cut[t.offs[:-1][np.diff(t.offs) > 0]] = True
        return np.flatnonzero(cut)

    def _special(self, t: Text) -> np.ndarray:
        """The texts that hold a special token's string, in whatever case."""
        if self.special is None or self.lead not in (data := t.data.tobytes()):
            return np.zeros(0, np.int64)
        found = [m.start() for m in self.special.finditer(data)]
        return np.unique(np.searchsorted(t.offs, found, "right") - 1)

    def encode(self, t: Text) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's ids begin (one more entry at the end)."""
        whole = self._special(t) if self.fast else np.zeros(0, np.int64)
        if len(whole):
            gone = np.isin(np.arange(t.n), whole)
            size = np.diff(t.offs)
            rest, at = self.encode(Text(t.data[np.repeat(~gone, size)], np.append(0, np.cumsum(np.where(gone, 0, size)))))
            ids = [np.frombuffer(self._whole(t.bytes(i).decode()), "<u4") if gone[i] else rest[at[i] : at[i + 1]] for i in range(t.n)]
            return np.concatenate(ids), np.cumsum([0, *map(len, ids)])
        if not self.fast:
            ids = [np.frombuffer(self._whole(t.bytes(i).decode()), "<u4") for i in range(t.n)]
            return np.concatenate([*ids, np.zeros(0, "<u4")]), np.cumsum([0, *map(len, ids)])
        if not len(t.data):
            return np.zeros(0, "<u4"), np.zeros(t.n + 1, np.int64)
        cuts = self._cuts(t)
        edges = np.append(cuts, len(t.data)).astype(np.int64)
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(t.data))]).dictionary_encode()
        have = self.new.get
        ids = [have(p) or self._piece(p) for p in pieces.dictionary.to_pylist()]
        flat = np.frombuffer(b"".join(ids), "<u4")
        length = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        start = np.cumsum(length) - length
        code = pieces.indices.to_numpy()
        n = length[code]
        before = np.zeros(len(n) + 1, np.int64)
        np.cumsum(n, out=before[1:])
        out = flat[np.arange(before[-1]) + np.repeat(start[code] - before[:-1], n)]
        return out, before[np.searchsorted(cuts, t.offs)]


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, plain: bool = False) -> Encoder:
    """This process's encoder for the file, with what it has cached."""
    if (path, plain) not in _encoders:
        _encoders[path, plain] = Encoder(path, plain)
    return _encoders[path, plain]


def encoded(column: pa.Array, path: str, end: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row, and ids with the end id, of each text of the column."""
    e = encoder(path)
    for i, _, t in slices(column, TEXT_LIMIT):
        ids, at = e.encode(t)
        for j in range(t.n):
            yield i + j, np.append(ids[at[j] : at[j + 1]], np.uint32(end)).astype("<u4")

"""SentencePiece encoding and decoding for merge-type vocabularies.

A text is a row of symbols, at first its code points. An agenda holds every pair of
adjacent symbols whose concatenation is in the vocabulary; the pair of best score, of equal
ones the leftmost, is merged, its new neighbours enter the agenda, and pairs that no longer
stand are passed over. A symbol that is not in the vocabulary at the end is spelt in bytes. The agendas of a batch's words lie side by side in an
array, one round of which takes the best pair of every word; a long word has a heap.

No entry of the vocabulary goes on after a space within it, so a text falls into words, each
with the spaces before it, and no merge crosses. Equal words of a slice are found by Arrow's
dictionary encoding and encoded once. In each Arrow batch, the sentencepiece library encodes
the distinct words too, and a difference is an error; ``check`` does so with the whole texts.

Defined results: null and empty texts have no id, and no ids (or null) decode to the empty
text; a text of any length is handled whole, in memory in proportion to it, which
is most (some 300 bytes a character) for a word of megabytes; repeated rows each get their
result; an empty table stays one; other columns are kept, one that has the
name of the result is replaced.
"""

from __future__ import annotations

from functools import cached_property
from hashlib import sha256
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scan import LEAD, Text, in_batches, slices

TEXT_LIMIT = 1 << 22
WIDTHS = (8, 16, 32)  # characters of words that are merged side by side
ROWS = 1 << 14  # of them at a time
CHECKED = 32  # words that the library gets at a time
NEVER, GONE, BEYOND = 2**31 - 1, -1, 1 << 24
SPACE = "▁"  # stands for a space in the vocabulary


class PieceEncoder:
    """The ids of texts by a vocabulary file."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        own, n = self.library, self.library.vocab_size()
        plain = [i for i in range(n) if not (own.is_byte(i) or own.is_control(i) or own.is_unknown(i))]
        self.ids = {own.id_to_piece(i): i for i in plain}
        order = {x: i for i, x in enumerate(sorted({own.get_score(i) for i in plain}, reverse=True))}
        #: two symbols: the place of their merger's score, and the merger
        self.places = {a << 32 | b: (order[own.get_score(i)], i) for x, i in self.ids.items() for cut in range(1, len(x)) if (a := self.ids.get(x[:cut])) is not None and (b := self.ids.get(x[cut:])) is not None}
        self.pair_keys = np.array(sorted(self.places), np.int64)
        self.pair_places, self.pair_made = np.array([self.places[k] for k in self.pair_keys.tolist()], np.int32).T.copy()
        self.first = np.arange(BEYOND, BEYOND + 0x110000, dtype=np.int32)
        for x, i in self.ids.items():
            if len(x) == 1:
                self.first[ord(" " if x == SPACE else x)] = i
        self.bytes = [own.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self._demand(n)
        self.apart = np.ones((256, 256), bool)  # last byte of one character, first of the next
        for piece in self.ids:
            if SPACE in piece.lstrip(SPACE):
                raise ValueError("the vocabulary has entries of several words")
            chars = [x.encode() for x in piece.replace(SPACE, " ")]
            for a, b in zip(chars, chars[1:], strict=False):
                self.apart[a[-1], b[0]] = False

    def _demand(self, n: int) -> None:
        """What this encoder does not do is refused and not guessed."""
        own = self.library
        if any(own.is_unused(i) for i in range(n)):
            raise ValueError("the vocabulary has unused pieces")
        if not all(own.is_byte(i) for i in self.bytes):
            raise ValueError("the vocabulary has no bytes to fall back to")
        for probe, shown in ((" a  b ", f"{SPACE}{SPACE}a{SPACE}{SPACE}b{SPACE}"), ("ﬁÅ\t\n", f"{SPACE}ﬁÅ\t\n")):
            if own.normalize(probe) != shown:
                raise ValueError("the vocabulary's normaliser changes texts")
        for probe in ("lower newest widest", "  12é\U0001f642 a"):
            long = np.array(self._long(self._symbols(" " + probe).tolist()))
            if own.encode(probe) != self._spelt_out(long, np.array([0, len(long)]))[0].tolist():
                raise ValueError("not a merge-type vocabulary")

    def _places(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each pair in the order of scores, or NEVER, and the row of its merger."""
        key = a.astype(np.int64) << 32 | b
        row = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[row] == key, self.pair_places[row], NEVER), row

    def _side_by_side(self, symbols: np.ndarray) -> None:
        """Merges the words in the rows of ``symbols`` (the last column is GONE, as what lies
        behind a word) in place. Each has its agenda in the row of an array, by position, and
        in each round does the merger that comes first on it."""
        n, width = symbols.shape
        left, right = (np.tile(np.arange(width, dtype=np.int16) + d, (n, 1)) for d in (-1, 1))
        left[:, 0] = width - 1
        agenda, made = np.full((n, width), NEVER, np.int32), np.zeros((n, width), np.int32)
        agenda[:, :-1], made[:, :-1] = self._places(symbols[:, :-1], symbols[:, 1:])
        at = np.arange(n)
        while True:
            i = agenda[at].argmin(1) if len(at) < n else agenda.argmin(1)
            go = agenda[at, i] != NEVER
            at, i = at[go], i[go]
            if not len(at):
                return
            symbols[at, i] = self.pair_made[made[at, i]]
            j = right[at, i]
            symbols[at, j] = GONE
            agenda[at, j] = NEVER
            k, h = right[at, j], left[at, i]
            right[at, i] = k
            left[at, k] = i
            for x, y in ((i, k), (h, i)):
                agenda[at, x], made[at, x] = self._places(symbols[at, x], symbols[at, y])

    def _long(self, symbols: list[int]) -> list[int]:
        """The same for one word, whose agenda is a heap of place and position."""

        def place(a: int, b: int) -> int:
            return self.places.get(a << 32 | b, (NEVER, 0))[0]

        n = len(symbols)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = [x << 32 | i for i in range(n - 1) if (x := place(symbols[i], symbols[i + 1])) != NEVER]
        heapify(agenda)
        while agenda:
            best, i = divmod(heappop(agenda), 1 << 32)
            if symbols[i] == GONE or (j := right[i]) == n or place(symbols[i], symbols[j]) != best:
                continue  # no longer stands
            symbols[i], symbols[j] = self.places[symbols[i] << 32 | symbols[j]][1], GONE
            right[i] = k = right[j]
            for a, b in ((i, k), (left[i], i)):
                if a >= 0 and b < n:
                    left[b] = a
                    if (x := place(symbols[a], symbols[b])) != NEVER:
                        heappush(agenda, x << 32 | a)
        return [x for x in symbols if x != GONE]

    def _apart(self, word: str) -> list[str]:
        """Two symbols can only merge if an entry holds the characters on both sides of their
        border, so a long word is cut where none does."""
        d = np.frombuffer(word.encode(), np.uint8)
        cuts = [0, *(np.flatnonzero(self.apart[d[:-1], d[1:]] & LEAD[d[1:]]) + 1).tolist(), len(d)]
        return [d[a:b].tobytes().decode() for a, b in zip(cuts, cuts[1:], strict=False)]

    def _symbols(self, text: str) -> np.ndarray:
        """A character that is no entry has its code point, beyond all ids, for a symbol."""
        return self.first[np.frombuffer(text.encode("utf-32-le"), np.uint32)]

    def _spelt_out(self, symbols: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and each word's first, with bytes for the symbols that are no ids."""
        odd = np.flatnonzero(symbols >= BEYOND)
        if not len(odd):
            return symbols, begin
        kinds, which = np.unique(symbols[odd], return_inverse=True)
        spelt = [[self.bytes[b] for b in chr(x - BEYOND).encode()] for x in kinds.tolist()]
        many = np.ones(len(symbols), np.int64)
        many[odd] = np.array([len(x) for x in spelt])[which]
        at = np.append(0, np.cumsum(many))
        out = np.repeat(symbols, many)
        for k in range(4):
            own = np.array([x[k] if k < len(x) else GONE for x in spelt])[which]
            out[at[odd[own != GONE]] + k] = own[own != GONE]
        return out, at[begin]

    def merge(self, words: bytes, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words that ``offs`` deals out, and each one's first (one more entry
        at the end)."""
        text = words.decode()
        symbols = self._symbols(text)
        at = np.append(0, np.cumsum(LEAD[np.frombuffer(words, np.uint8)]))[offs]
        length = np.diff(at)
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # words, their numbers of ids, ids
        for low, width in zip((0, *WIDTHS), WIDTHS, strict=False):
            of = np.flatnonzero((length > low) & (length <= width))
            for k in range(0, len(of), ROWS):
                part = of[k : k + ROWS]
                cells = np.full((len(part), width + 1), GONE, np.int32)
                where = np.arange(width + 1)
                inside = where < length[part, None]
                cells[inside] = symbols[(at[part, None] + where)[inside]]
                self._side_by_side(cells)
                stay = cells != GONE
                parts.append((part, stay.sum(1), cells[stay]))
        for i in np.flatnonzero(length > WIDTHS[-1]).tolist():
            ids = [x for piece in self._apart(text[at[i] : at[i + 1]]) for x in self._long(self._symbols(piece).tolist())]
            parts.append((np.array([i]), np.array([len(ids)]), np.array(ids, np.int32)))
        many = np.zeros(len(length), np.int64)
        for part, n, _ in parts:
            many[part] = n
        begin = np.append(0, np.cumsum(many))
        out = np.empty(begin[-1], np.int32)
        for part, n, ids in parts:
            out[np.arange(len(ids)) + np.repeat(begin[part] - (np.cumsum(n) - n), n)] = ids
        return self._spelt_out(out, begin)

    def _checked(self, words: bytes, offs: np.ndarray, ids: np.ndarray, begin: np.ndarray) -> None:
        """The library encodes the words too, some at a time, as they follow one another. It
        adds the first of their spaces by itself."""
        data = np.frombuffer(words, np.uint8)
        blank = np.diff(offs) == np.diff(np.append(0, np.cumsum(data == 0x20))[offs])  # else they would join the next word
        for i in np.flatnonzero(blank & (np.diff(offs) > 1)).tolist():  # the library gives an empty text no space
            if self.library.encode(" " * int(offs[i + 1] - offs[i] - 1)) != ids[begin[i] : begin[i + 1]].tolist():
                raise ValueError("the library has other ids for spaces")
        stay = np.flatnonzero(~blank)
        text = data[np.repeat(~blank, np.diff(offs))].tobytes()
        cuts = np.append(0, np.cumsum(np.diff(offs)[stay]))[:: CHECKED].tolist()
        own = self.library.encode([text[a:b].decode()[1:] for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True) if b > a], num_threads=1)
        if not np.array_equal(ids[np.repeat(~blank, np.diff(begin))], np.fromiter(chain.from_iterable(own), np.int32)):
            raise ValueError("the library has other ids for words of the batch")

    def encode(self, t: Text) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, whose spaces in front are there already, and where each
        text's ids begin (one more entry at the end)."""
        d = t.data
        if not len(d):
            return np.zeros(0, "<u4"), np.zeros(t.n + 1, np.int64)
        cut = np.zeros(len(d), bool)
        cut[1:] = (d[1:] == 0x20) & (d[:-1] != 0x20)
        cut[t.offs[:-1][np.diff(t.offs) > 0]] = True
        cuts = np.flatnonzero(cut)
        edges = np.append(cuts, len(d)).astype(np.int64)
        found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(d))]).dictionary_encode()
        words = found.dictionary
        offs = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, words.offset * 8)
        text = words.buffers()[2].slice(offs[0], offs[-1] - offs[0]).to_pybytes()
        ids, begin = self.merge(text, offs - offs[0])
        self._checked(text, offs - offs[0], ids, begin)
        code = found.indices.to_numpy()
        many = np.diff(begin)[code]
        before = np.append(0, np.cumsum(many))
        out = ids[np.arange(before[-1]) + np.repeat(begin[code] - before[:-1], many)]
        return out.astype("<u4"), before[np.searchsorted(cuts, t.offs)]

    @cached_property
    def spelt(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all entries, one after another, and where each begins."""
        own = self.library
        byte = {i: bytes([b]) for b, i in enumerate(self.bytes)}
        each = [byte.get(i) or own.id_to_piece(i).replace(SPACE, " ").encode() for i in range(own.vocab_size())]
        return np.frombuffer(b"".join(each), np.uint8), np.cumsum([0, *map(len, each)])


def spaced(t: Text) -> Text:
    """The texts as the vocabulary sees them: U+2581 is a space, and a text that is not empty
    has one more space in front."""
    d, offs = t.data, t.offs.astype(np.int64)
    at = np.flatnonzero((d[:-2] == 0xE2) & (d[1:-1] == 0x96) & (d[2:] == 0x81)) if len(d) > 2 else np.zeros(0, np.int64)
    if len(at):
        keep = np.ones(len(d), bool)
        keep[at + 1] = keep[at + 2] = False
        d = d.copy()
        d[at] = 0x20
        d = d[keep]
        offs = offs - 2 * np.searchsorted(at, offs)
    some = np.diff(offs) > 0
    return Text(np.insert(d, offs[:-1][some], 0x20), offs + np.append(0, np.cumsum(some)))


_encoders: dict[str, PieceEncoder] = {}


def piece_encoder(path: str) -> PieceEncoder:
    """This process's encoder for the file."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def encode_texts(column: pa.Array, model: str, check: bool = False) -> pa.Array:
    """The ids of each text of the column."""
    e = piece_encoder(model)
    out = []
    for i, j, t in slices(column, TEXT_LIMIT):
        ids, at = e.encode(spaced(t))
        if check:
            for k, own in enumerate(e.library.encode([t.bytes(k).decode() for k in range(t.n)], num_threads=1)):
                if own != ids[at[k] : at[k + 1]].tolist():
                    raise ValueError(f"row {i + k} of a batch: the library has other ids")
        out.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32), pa.int32())))
    return pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.int32()))


def decode_ids(column: pa.Array, model: str) -> pa.Array:
    """The text of each list of ids, by the library."""
    own = piece_encoder(model).library
    return pa.array([own.decode(x or []) for x in column.to_pylist()], pa.string())


def encode(docs: DataFrame, model: str, text: str = "text", ids: str = "ids", check: bool = False) -> DataFrame:
    """``docs`` with the ids of ``text``, without begin or end ids."""

    @F.arrow_udf("array<int>")
    def run(column: pa.Array) -> pa.Array:
        return encode_texts(column, model, check)

    # else the optimizer repeats it wherever the ids are used
    return in_batches(docs).withColumn(ids, run.asNondeterministic()(F.col(text)))


def decode(tokens: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``tokens`` with the text of ``ids``."""

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        return decode_ids(column, model)

    return in_batches(tokens).withColumn(text, run.asNondeterministic()(F.col(ids)))


def ids_sha256(ids: Column) -> Column:
    """sha-256 of the decimal ids, joined by commas."""

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        joined = pc.binary_join(pc.cast(column, pa.list_(pa.string())), ",")
        return pa.array([sha256(x.as_buffer()).hexdigest() for x in joined], pa.string())

    return run(ids)

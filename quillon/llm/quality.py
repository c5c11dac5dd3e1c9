"""Quality rules by weak supervision.

Each rule looks at one property of a text and votes good, bad, or abstains. No rule is
trusted by itself: expectation-maximisation over the votes of *all* documents estimates
how often each rule gives each vote on good and on bad documents (its accuracy), and the
posterior probability of "good" given all votes decides, instead of all rules having to
pass. Votes are coded as one number (3 ** len(RULES) values at most), so the estimation
sees a histogram of bounded size, whatever the number of documents, and it is exact.

Defined results: a null text counts as empty, it has no words and all rules but the
length rule abstain; an empty table gives an empty table; repeated rows are judged each
by itself, and equally; a text of any length is judged whole, in memory in proportion to it
(some 60 bytes a byte); the other columns of the input are not looked at, ``keep_good`` keeps
them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import ALNUM, LEAD, Text, in_batches, mix, owners, pieces, slices, totals, windows

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
LETTER = UPPER | np.roll(UPPER, 32)
BANG = np.zeros(256, bool)
BANG[33] = True

#: Name, and of the property's value the bounds: good below the first, bad above the second.
RULES = (
    ("symbols per word", 0.05, 0.2),
    ("share of words in repeated 3-word windows", 0.15, 0.4),
    ("share of lines that repeat", 0.1, 0.3),
    ("share of upper case", 0.2, 0.5),
    ("share of words without letters or digits", 0.02, 0.15),
    ("exclamation marks per word", 0.05, 0.25),
    ("share of words equal to the word before", 0.05, 0.2),
    ("distance of the mean word length from 5.5", 2.5, 5.0),
    ("share of words with a symbol", 0.05, 0.2),
    ("share of characters other than letters and digits", 0.12, 0.22),
    ("words missing to 80", 1.0, 30.0),
)
BASE_MIN_WORDS, BASE_MAX_REPEAT_PERCENT = 50, 50
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_PLACE = 3 ** np.arange(len(RULES))
_SALT = np.uint64(0x9E3779B97F4A7C15)


def _repeats(hashes: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each item occurs twice or more in its document, and whether it did before."""
    _, first, back, count = np.unique(mix(hashes + of.astype(np.uint64) * _SALT), return_index=True, return_inverse=True, return_counts=True)
    again = np.ones(len(hashes), bool)
    again[first] = False
    return count[back] > 1, again


def measure(t: Text) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The base counts, and the coded votes, of each text."""
    starts, ends, first = t.words
    n = np.diff(first)
    hashes = t.hashes(t.raw_sums, starts, ends)
    h, at, runs = windows(hashes, first, 3)
    many, _ = _repeats(h, owners(runs))
    edge = np.zeros(len(starts) + 1, np.int64)
    np.add.at(edge, at[many], 1)
    np.add.at(edge, at[many] + 3, -1)
    repeat = totals(np.cumsum(edge)[:-1] > 0, first)

    l_starts, l_ends, l_first = t.lines
    inside = np.zeros(len(t.data) + 1, np.int64)
    np.cumsum(t.solid, out=inside[1:])
    said = inside[l_ends] > inside[l_starts]
    lines = np.flatnonzero(said)
    dup = np.zeros(len(said), bool)
    dup[lines] = _repeats(t.hashes(t.raw_sums, l_starts[lines], l_ends[lines]), owners(l_first)[lines])[1]

    alnum, symbols = np.zeros((2, len(t.data) + 1), np.int64)
    np.cumsum(ALNUM[t.data], out=alnum[1:])
    np.cumsum(SYMBOL[t.data], out=symbols[1:])
    same = np.zeros(len(starts), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same[first[:-1][n > 0]] = False
    counts = {
        "n_words": n,
        "word_chars": totals(LEAD[t.data] & t.solid, t.offs),
        "n_symbols": totals(SYMBOL[t.data], t.offs),
        "n_dup_lines": totals(dup, l_first),
        "n_repeat_words": repeat,
    }
    some, n_lines, letters = np.maximum(n, 1), totals(said, l_first), totals(LETTER[t.data], t.offs)
    values = (
        counts["n_symbols"] / some,
        repeat / some,
        counts["n_dup_lines"] / np.maximum(n_lines, 1),
        totals(UPPER[t.data], t.offs) / np.maximum(letters, 1),
        totals(alnum[ends] == alnum[starts], first) / some,
        totals(BANG[t.data], t.offs) / some,
        totals(same, first) / some,
        np.abs(counts["word_chars"] / some - 5.5),
        totals(symbols[ends] > symbols[starts], first) / some,
        1 - totals(ALNUM[t.data] & LEAD[t.data], t.offs) / np.maximum(counts["word_chars"], 1),
        np.maximum(80 - n, 0),
    )
    votes = np.zeros(t.n, np.int64)
    for j, (value, (_, good, bad)) in enumerate(zip(values, RULES, strict=True)):
        vote = 1 + (value < good) - (value > bad)
        if j < len(RULES) - 1:
            vote[n == 0] = 1
        votes += vote * _PLACE[j]
    return counts, votes


def _measured(column: pa.Array) -> dict[str, np.ndarray]:
    parts = [c | {"votes": v} for c, v in (measure(t) for _, _, t in slices(column))]
    return {k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in (*COUNTS, "votes")}


def profile(docs: DataFrame, key: str | None = "doc_id", text: str = "text") -> DataFrame:
    """The base counts and coded votes of every text, beside ``key`` if one is named."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = {k: pa.array(v, pa.int64()) for k, v in _measured(b.column(b.num_columns - 1)).items()}
            yield pa.RecordBatch.from_pydict(({"key": b.column(0)} if key else {}) | m)

    kind = f"key {docs.schema[key].dataType.simpleString()}, " if key else ""
    out = in_batches(docs.select(*([F.col(key)] if key else []), F.col(text))).mapInArrow(run, kind + ", ".join(f"{c} long" for c in (*COUNTS, "votes")))
    return out.withColumnRenamed("key", key) if key else out


@dataclass(frozen=True)
class Model:
    """``share`` of good documents, and of each rule and class (bad, good) the
    probabilities of the votes (bad, none, good)."""

    share: float
    votes: np.ndarray

    def posterior(self, coded: np.ndarray) -> np.ndarray:
        """Probability that a document with these votes is good."""
        odds = np.full(len(coded), np.log(self.share / (1 - self.share)))
        for j, place in enumerate(_PLACE):
            p = np.log(self.votes[j])
            odds += (p[1] - p[0])[(coded // place) % 3]
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit(profiled: DataFrame, rounds: int = 60, shares: tuple[float, float] = (0.05, 0.95)) -> Model:
    """Estimate the model from the votes of all documents. Good is the class in which the
    rules' good votes prevail: the start takes each rule as right more often than wrong,
    and one clear bad vote as a sign of a bad document. The share of good documents stays
    within ``shares``: a corpus that is nearly all of one class must not make its votes
    count for nothing. (0, 1) leaves it free."""
    rows = profiled.groupBy("votes").agg(F.count("*").alias("n")).collect()  # 3 ** len(RULES) rows at most
    coded = np.array(sorted((r["votes"], r["n"]) for r in rows), np.int64).reshape(-1, 2)
    coded, n = coded[:, 0], coded[:, 1].astype(float)
    vote = (coded[:, None] // _PLACE) % 3
    good = np.where((vote == 0).any(1), 0.2, 0.9)
    share, table = 0.8, np.full((len(RULES), 2, 3), 1 / 3)
    for _ in range(rounds):
        for c, w in enumerate((n * (1 - good), n * good)):
            for j in range(len(RULES)):
                table[j, c] = np.bincount(vote[:, j], w, 3) + 0.5
            table[:, c] /= table[:, c].sum(1, keepdims=True)
        # a rule speaks for its side: a bad vote is never a sign of a good document
        table[:, 1, 0] = np.minimum(table[:, 1, 0], table[:, 0, 0])
        table[:, 1] /= table[:, 1].sum(1, keepdims=True)
        share = float(np.clip((n @ good + 1) / (n.sum() + 2), *shares)) if len(n) else 0.8
        good = Model(share, table).posterior(coded)
    return Model(share, table)


def _verdict(c: dict[str, np.ndarray], model: Model, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    p = model.posterior(c["votes"])
    failed = (c["n_words"] < BASE_MIN_WORDS) | (100 * c["n_repeat_words"] > BASE_MAX_REPEAT_PERCENT * c["n_words"])
    return p, failed, ~failed & (p >= least)


def judge(profiled: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """``profiled`` with quality (the posterior), base_failed and kept."""
    names = profiled.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = {k: b.column(names.index(k)).to_numpy(zero_copy_only=False) for k in (*COUNTS, "votes")}
            p, failed, kept = _verdict(c, model, least)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p), pa.array(failed), pa.array(kept)], [*names, "quality", "base_failed", "kept"])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in profiled.schema]
    return profiled.mapInArrow(run, ", ".join([*kinds, "quality double", "base_failed boolean", "kept boolean"]))


def keep_good(docs: DataFrame, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, unchanged, whose text is kept. Texts are scanned twice and
    never shuffled: once for the votes of all, once to apply the verdict."""
    model, at = fit(profile(docs, None, text)), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, t in pieces(b, at):
                counts, votes = measure(t)
                yield rows.filter(pa.array(_verdict(counts | {"votes": votes}, model, least)[2]))

    return in_batches(docs).mapInArrow(run, docs.schema)

"""Language identification as inference of a mixture.

Training counts byte trigrams of each language over all labelled documents. A document is a
mixture: each of its words is drawn from one of its languages with the document's
proportions, and expectation-maximisation over the words' trigram likelihoods estimates
these. The set of languages follows from the penalised likelihood: sets of one, two and
more languages (the most probable ones) are fitted, and a further language must raise the
log-likelihood by more than half the logarithm of the number of words.

Defined results: ``und`` with score 0 for null texts, texts without a letter, and if no
language was learned; rows are judged each by itself; rows without language or id are not
learned from; an empty table gives an empty table; of languages that are equally probable the
first in order of name is taken; a text of any length is judged whole, in memory in proportion
to it (some 60 bytes a byte); other columns are not kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import LOWER, WHITE, Text, in_batches, slices

BUCKETS = 1 << 15
ROUNDS = 8
NONE = "und"
#: Letters stay, all else is a space.
_SHOWN = LOWER.copy()
_SHOWN[[b for b in range(128) if not (65 <= b <= 90 or 97 <= b <= 122)]] = 32


def _grams(t: Text) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bucket of the trigram that ends at each byte; words' starts and ends; each
    document's first word."""
    d = _SHOWN[t.data]
    starts, ends, first = t.spans(d != 32)
    w = d.astype(np.uint32)
    one, two = np.full_like(w, 32), np.full_like(w, 32)
    one[1:], two[2:] = w[:-1], w[:-2]
    one[t.offs[:-1][t.offs[:-1] < len(w)]] = 32
    late = np.concatenate([t.offs[:-1], t.offs[:-1] + 1])
    two[late[late < len(w)]] = 32
    return ((w | (one << np.uint32(8)) | (two << np.uint32(16))) * np.uint32(2654435761) >> np.uint32(17)).astype(np.int64), starts, ends, first


@dataclass(frozen=True)
class Model:
    languages: list[str]
    logs: np.ndarray  # bucket, language

    def mixture(self, t: Text) -> tuple[np.ndarray, np.ndarray]:
        """Of each document the proportions, and the number of words."""
        g, starts, ends, first = _grams(t)
        n, k = np.diff(first), len(self.languages)
        share = np.zeros((t.n, k))
        has = np.flatnonzero(n)
        if not len(has) or not k:
            return share, n
        # the trigrams that end in the word; the space after it adds nothing new
        sums = np.zeros((len(g) + 1, k))
        np.cumsum(self.logs[g], axis=0, out=sums[1:])
        ll = sums[ends] - sums[starts]
        top = ll.max(1, keepdims=True)
        p = np.exp(ll - top)
        at, doc = first[:-1][has], np.repeat(np.arange(len(has)), n[has])
        base = np.add.reduceat(top[:, 0], at)
        words = n[has].astype(float)

        def fit(docs: np.ndarray, allowed: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
            """Proportions and log-likelihood of some documents, given their languages."""
            use = np.isin(doc, docs) if len(docs) < len(has) else slice(None)
            q, of = p[use], np.searchsorted(docs, doc[use])
            begin = np.searchsorted(of, np.arange(len(docs)))
            pi = allowed / allowed.sum(1, keepdims=True)
            for _ in range(rounds):
                r = q * pi[of]
                r /= np.maximum(r.sum(1, keepdims=True), 1e-300)
                pi = np.add.reduceat(r, begin) / words[docs][:, None]
            total = np.add.reduceat(np.log(np.maximum((q * pi[of]).sum(1), 1e-300)), begin)
            return pi, total + base[docs]

        everyone = np.arange(len(has))
        pi, _ = fit(everyone, np.ones((len(has), k)), ROUNDS)
        order = np.argsort(-pi, axis=1)
        alone = np.add.reduceat(ll, at)
        one = np.argmax(alone, axis=1)
        best = np.zeros((len(has), k))
        best[everyone, one] = 1
        score = alone[everyone, one]
        still = everyone
        for size in range(2, k + 1):
            allowed = np.zeros((len(still), k))
            np.put_along_axis(allowed, order[still][:, :size], 1, 1)
            pi, total = fit(still, allowed, ROUNDS // 2)
            total -= 0.5 * (size - 1) * np.log(words[still])
            better = total > score[still]
            still = still[better]
            best[still], score[still] = pi[better], total[better]
            if not len(still):
                break
        share[has] = best
        return share, n

    def predict(self, t: Text) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score, and the number of languages of each document."""
        share, n = self.mixture(t)
        if not self.languages:
            return [NONE] * t.n, np.zeros(t.n), np.zeros(t.n, np.int64)
        best, score = share.argmax(1), share.max(1)
        names = [self.languages[i] for i in best]
        for i in np.flatnonzero(n == 0):
            names[i] = NONE
        # bytes of other scripts count as letters above, marks and symbols among them do not
        ascii_letters = np.zeros(len(t.data) + 1, np.int64)
        np.cumsum((t.data < 128) & (_SHOWN[t.data] != 32), out=ascii_letters[1:])
        for i in np.flatnonzero((np.diff(ascii_letters[t.offs]) == 0) & (n > 0)):
            if not any(map(str.isalpha, t.bytes(i).decode(errors="replace"))):
                names[i], score[i] = NONE, 0.0
        return names, score, (share > 0.01).sum(1)


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Trigram counts of all rows. The result has ``BUCKETS`` rows for each language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for b in batches:
            names = np.array(b.column(0).to_pylist(), object)
            for i, j, t in slices(b.column(1)):
                g, starts, ends, first = _grams(t)
                inside = _SHOWN[t.data] != 32
                of = np.repeat(np.arange(t.n), np.diff(t.offs))
                for name in set(names[i:j]):
                    mine = (names[i:j] == name)[of] & inside
                    seen.setdefault(name, np.zeros(BUCKETS, np.int64))
                    seen[name] += np.bincount(g[mine], minlength=BUCKETS)
        for name, c in seen.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(c[at], pa.int64())], ["lang", "gram", "n"])

    rows = labelled.select(lang, text).where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = in_batches(rows).mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(counts.column("lang").to_pylist()))
    table = np.full((BUCKETS, len(names)), 0.5)
    at = {x: i for i, x in enumerate(names)}
    table[counts.column("gram").to_numpy(), [at[x] for x in counts.column("lang").to_pylist()]] += counts.column("n").to_numpy()
    return Model(names, np.log(table / table.sum(0)) if names else table)


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred, score (the language's proportion), n_langs (size of the set)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, score, size = [], [], []
            for _, _, t in slices(b.column(1)):
                x = shared.value.predict(t)
                names += x[0]
                score.append(x[1])
                size.append(x[2])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.string()), *(pa.array(np.concatenate(x) if x else [], k) for x, k in ((score, pa.float64()), (size, pa.int64())))], ["key", "lang_pred", "score", "n_langs"])

    return in_batches(docs.select(key, text)).mapInArrow(run, f"key {docs.schema[key].dataType.simpleString()}, lang_pred string, score double, n_langs long").withColumnRenamed("key", key)

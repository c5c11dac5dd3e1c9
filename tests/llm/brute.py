"""Plain versions of the operators, written from their contracts, a document at a time."""

import collections
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def quality_counts(text):
    text = text or ""
    w = WORD.findall(text)
    n = collections.Counter(zip(w, w[1:], w[2:]))
    hit = set()
    for i, x in enumerate(zip(w, w[1:], w[2:])):
        if n[x] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    c = {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(hit),
    }
    return c | {"base_failed": len(w) < 50 or 100 * len(hit) > 50 * len(w)}


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def shingles(text, k):
    w = WORD.findall(lower(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def components(texts, k, percent):
    """For each place, the smallest place that links reach."""
    sets = [shingles(t, k) for t in texts]
    up = list(range(len(texts)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            both = len(a & b)
            if a and b and 100 * both >= percent * (len(a) + len(b) - both):
                x, y = sorted((top(i), top(j)))
                up[y] = x
    return [len(s) for s in sets], [top(i) for i in range(len(texts))]


def dedup_lines(docs, min_chars=20, min_docs=3):
    """docs: (id, text) pairs. Texts after, lines before, lines dropped."""
    strip = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    held = collections.defaultdict(set)
    for i, t in docs:
        for x in (t or "").split("\n"):
            if i is not None and len(strip(x)) >= min_chars:
                held[strip(x)].add(i)
    keep = {k: max(v) for k, v in held.items() if len(v) >= min_docs}
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        left = [x for x in lines if i is None or keep.get(strip(x), i) == i]
        out.append(("\n".join(left), len(lines), len(lines) - len(left)))
    return out


BENCH = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def hits(text, items, window=10):
    """Number of words, indexes of those hit, ids of the items."""
    w = BENCH.findall(lower(text or ""))
    found, ids = set(), set()
    for k, t in items:
        x = BENCH.findall(lower(t or ""))
        n = min(len(x), window)
        for i in range(len(x) - n + 1 if x else 0):
            for j in range(len(w) - n + 1):
                if w[j : j + n] == x[i : i + n]:
                    found |= set(range(j, j + n))
                    ids.add(k)
    return len(w), found, ids

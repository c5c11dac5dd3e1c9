"""URL filtering by rules, with Bloom filter cascades.

A rule is ``host/path``; it fits its host and all subdomains where the url's path starts
with the rule's path, and the longest rule that fits wins. The candidates of a url are all
its host's suffixes, each with the beginnings of its path that are as long as some rule's
path; the rule that wins is the longest candidate on a list. Whether a candidate is on a
list is answered without joins: a cascade of Bloom filters over the *complete* set of
candidates of the corpus. The first level holds the listed keys, the second the other
candidates that the first lets through, the third the listed keys that the second lets
through, and so on until none is left, so the answer is exact for every candidate. The
first level's error rate follows the ratio of listed keys to candidates, which keeps all
levels together at a few bits for each listed key (more only with the logarithm of the
corpus). A cascade holds at most ``MOST`` listed keys; longer lists are dealt by hash to
several cascades, each over its part of the candidates.

Urls without a rule are judged by a second cascade over their hosts: those with a listed
word in a label are blocked, others allowed.

DataFrame functions only. Defined results: null, and urls without ``://``, have an empty
host and path and are allowed, with no rule; equal rows are judged each by itself; no two
rules of a length fit one url, but a rule on both lists allows; urls of any length are judged
whole; a rule without a ``/`` is an error; empty tables and lists are allowed; other columns
are kept by ``judge`` unless they have the name of a new one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import free_name, stage

MOST = 1 << 15  # listed keys of a cascade
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Words (between hyphens, in a host's label) of hosts to block where no rule fits.
LISTED_WORDS = ("ads", "bets", "casino", "pills", "poker", "spam", "viagra", "xxx")


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def suffixes(host: Column) -> Column:
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def candidates(host: Column, path: Column, lengths: list[int]) -> Column:
    """Strings like rules that fit the url, for all lengths of a rule's path."""
    begins = F.filter(F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]), lambda p: p.isNotNull()) if lengths else F.array().cast("array<string>")
    return F.flatten(F.transform(suffixes(host), lambda s: F.transform(begins, lambda p: F.concat(s, p))))


class Level:
    """One Bloom filter as 64-bit words in a literal."""

    def __init__(self, keys: DataFrame, count: int, hashes: int, salt: int):
        self.bits = max(64, math.ceil(1.4427 * hashes * count))
        self.hashes, self.salt = hashes, salt
        at = keys.select(F.explode(F.array(*self._positions(F.col("key")))).alias("at"))
        words = at.groupBy((F.col("at") / 64).cast("long").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at % 64 as int)))").alias("v")).collect()  # bits / 64 at most
        have = {r["word"]: r["v"] for r in words}
        text = ",".join(str(have.get(i, 0)) for i in range(self.bits // 64 + 1))
        self.words = F.split(F.lit(text), ",").cast("array<bigint>")  # folds to one literal

    def _positions(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.salt), F.lit(i)), F.lit(self.bits)) for i in range(self.hashes)]

    def has(self, key: Column) -> Column:
        found = None
        for p in self._positions(key):
            bit = F.getbit(F.element_at(self.words, (F.floor(p / 64) + 1).cast("int")), (p % 64).cast("int")) == 1
            found = bit if found is None else found & bit
        return found


class Cascade:
    """Membership in ``listed`` (column key) of keys in ``universe`` (column key)."""

    def __init__(self, listed: DataFrame, universe: DataFrame):
        listed = stage(listed.select("key").where("key IS NOT NULL").distinct(), "listed")
        universe = stage(universe.select("key").distinct(), "universe")
        count = listed.count()
        self.deals = max(1, -(-count // MOST))
        self.cascades = [self._build(self._dealt(listed, i), self._dealt(universe, i)) for i in range(self.deals)]

    def _deal(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key, F.lit("deal")), F.lit(self.deals))

    def _dealt(self, keys: DataFrame, i: int) -> DataFrame:
        return keys.where(self._deal(F.col("key")) == i) if self.deals > 1 else keys

    def _build(self, listed: DataFrame, universe: DataFrame) -> list[Level]:
        n = listed.count()
        if not n:
            return []
        rest = universe.join(F.broadcast(listed), "key", "left_anti")  # MOST keys, about; only to build
        ratio = max(1.0, universe.count() / n)
        levels = [Level(listed, n, max(1, math.ceil(math.log2(ratio * math.sqrt(2)))), 0)]
        inside, outside = listed, rest
        while True:
            # what the last level lets through though it is not meant
            outside = stage(outside.where(levels[-1].has(F.col("key"))), "cascade")
            n = outside.count()
            if not n:
                return levels
            levels.append(Level(outside, n, 1 if len(levels) < 12 else 4, len(levels)))
            inside, outside = outside, inside

    def has(self, key: Column) -> Column:
        def member(levels: list[Level]) -> Column:
            found = F.lit(False)
            for level in reversed(levels):
                found = level.has(key) & ~found if level is not levels[-1] else level.has(key)
            return found

        out = member(self.cascades[-1])
        for i, levels in enumerate(self.cascades[:-1]):
            out = F.when(self._deal(key) == i, member(levels)).otherwise(out)
        return F.coalesce(out, F.lit(False))


def listed_hosts(hosts: DataFrame, words: tuple[str, ...]) -> DataFrame:
    """The keys (hosts) with one of the words in a label."""
    inside = F.split(F.col("key"), r"[.\-]")
    return hosts.where(F.arrays_overlap(inside, F.array(*[F.lit(w) for w in words]))) if words else hosts.where("false")


def judge(pages: DataFrame, rules: list[tuple[str, str]], words: tuple[str, ...] = LISTED_WORDS, url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule (null if none fits) and verdict. ``rules``: pairs of
    allow or block, and host/path."""
    spark = pages.sparkSession
    if bad := [r for r in rules if r[0] not in ("allow", "block") or "/" not in r[1]]:
        raise ValueError(f"a rule is allow or block, and host/path; not {bad}")
    lengths = sorted({len(r) - r.index("/") for _, r in rules})
    host, path = parts(F.col(url))
    urls = pages.select(host.alias("host"), path.alias("path"))
    universe = stage(urls.select(F.explode(candidates(F.col("host"), F.col("path"), lengths)).alias("key")).distinct(), "candidates")
    lists = {kind: Cascade(spark.createDataFrame([(r,) for k, r in rules if k == kind], "key string"), universe) for kind in ("allow", "block")}
    hosts = urls.select(F.col("host").alias("key")).distinct()
    by_host = Cascade(listed_hosts(hosts, words), hosts)
    out = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host, "path": path})
    marked = F.transform(
        candidates(F.col("host"), F.col("path"), lengths),
        lambda c: F.struct(F.length(c).alias("length"), F.when(lists["allow"].has(c), "allow").when(lists["block"].has(c), "block").alias("verdict"), c.alias("rule")),
    )
    best = F.array_max(F.filter(marked, lambda c: c["verdict"].isNotNull()))
    fit = free_name(out.columns, "best_fit")
    return out.withColumn(fit, best).select(
        *out.columns,
        F.col(f"{fit}.rule").alias("rule"),
        F.coalesce(f"{fit}.verdict", F.when(by_host.has(F.col("host")), "block").otherwise("allow")).alias("verdict"),
    )

"""Reproducible samples of episodes: those with the smallest keyed hash, and orders of epochs."""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import positions


def sample_episodes(episodes: DataFrame, keys: list[str], n: int, seed: int = 0) -> DataFrame:
    """``n`` keys in an order that depends on ``seed`` and key only; one pass with a heap
    of ``n`` rows in each task."""
    rank = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return episodes.select(*keys).distinct().withColumn("rank_hash", rank).orderBy("rank_hash", *keys).limit(n).drop("rank_hash")


BROADCAST_KEYS = 1 << 16


def sampled_steps(steps: DataFrame, keys: list[str], n: int, seed: int = 0) -> DataFrame:
    """The steps of such a sample: up to BROADCAST_KEYS keys are broadcast; beyond, Spark
    plans the join."""
    few = sample_episodes(steps, keys, n, seed)
    return steps.join(F.broadcast(few) if n <= BROADCAST_KEYS else few, keys, "left_semi")


# --- orders without a sort

ROUNDS = 48


def number_rows(df: DataFrame, order: list[str], name: str = "row") -> DataFrame:
    """``df`` with the place of each row in the order, from 0, by a range partitioning: no task
    sees all rows. ``order`` must be total."""
    out = positions.place_steps(df, [], order, name)
    return out.select(*df.columns, name)


def permuted(row: Column, n: int, seed: int = 0, epoch: int = 0, rounds: int = ROUNDS) -> Column:
    """The place of row number ``row`` of ``n`` in the order of an epoch.

    Swap-or-not rounds: each pairs every number with its mirror about a keyed point, and swaps
    the pair or not by a keyed bit of the larger one. Each round is a bijection on [0, n), so
    the whole is, for any n, and a row's place needs no other row."""
    if n < 2:
        return row * 0
    key = lambda r: f"{seed}|{epoch}|{r}|"
    points = F.array(*[F.struct(F.lit(int(md5(key(r).encode()).hexdigest()[:12], 16) % n).alias("point"), F.lit(key(r)).alias("key")) for r in range(rounds)])

    def one(x: Column, k: Column) -> Column:
        mirror = (k["point"] + F.lit(n) - x) % F.lit(n)
        bit = F.substring(F.md5(F.concat(k["key"], F.greatest(x, mirror).cast("string"))), 1, 1) >= "8"
        return F.when(bit, mirror).otherwise(x)

    return F.aggregate(points, row.cast("long"), one)


def epoch_order(episodes: DataFrame, order: list[str], seed: int = 0, epoch: int = 0, name: str = "place") -> DataFrame:
    """``episodes`` with their places in an epoch's order, of which any range is a filter:
    ``place < 100`` are the first hundred. Another epoch is another order of the same rows."""
    numbered = number_rows(episodes, order, "row_number_")
    return numbered.withColumn(name, permuted(F.col("row_number_"), numbered.count(), seed, epoch)).drop("row_number_")

"""Profiles of vector columns, and previews of episodes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.images import strip

BINS = 20


def _long(steps: DataFrame, columns: list[str]) -> DataFrame:
    """kind, dim, value (double) of each vector element. Columns that are absent are
    skipped."""
    there = [c for c in columns if c in steps.columns]
    kinds = F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.transform(c, lambda x: x.cast("double")).alias("vector")) for c in there])).alias("v")
    return steps.select(kinds).select("v.kind", F.posexplode("v.vector").alias("dim", "value")).withColumn("dim", F.col("dim").cast("long"))


def ragged(steps: DataFrame, columns: list[str]) -> DataFrame:
    """Vector columns whose sizes differ: kind, smallest, largest. Empty if all is well."""
    sizes = [F.struct(F.lit(c).alias("kind"), F.size(c).alias("n")) for c in columns if c in steps.columns]
    return steps.select(F.explode(F.array(*sizes)).alias("s")).groupBy("s.kind").agg(F.min("s.n").alias("smallest"), F.max("s.n").alias("largest")).where("smallest <> largest")


def vector_mean(steps: DataFrame, columns: list[str]) -> DataFrame:
    """kind, dim, mean over all steps, and the number of values."""
    return _long(steps, columns).groupBy("kind", "dim").agg(F.avg("value").alias("mean"), F.count("value").alias("n"))


def vector_mean_wide(steps: DataFrame, column: str, size: int) -> DataFrame:
    """The means of one column in a single row; no row is expanded (for up to about 64
    dimensions)."""
    return steps.agg(*[F.avg(F.get(column, i).cast("double")).alias(f"m{i}") for i in range(size)])


def bin_of(value: Column, low: Column, high: Column, bins: int = BINS) -> Column:
    """The bin of equal bins over [low, high]: bin i holds edge i <= value < edge i + 1, and
    the last holds ``high``. It counts edges, as rounding a quotient differs on them."""
    edge = lambda i: F.lit(i) * ((high - low) / F.lit(bins)) + low
    return reduce(lambda a, b: a + b, [(value >= edge(i)).cast("long") for i in range(1, bins)], F.lit(0).cast("long"))


def vector_histogram(steps: DataFrame, columns: list[str], bins: int = BINS) -> DataFrame:
    """kind, dim, bin, n of the bins that hold values. A single value widens to half a unit
    on both sides. Values that are not finite are not binned; see ``vector_nonfinite``."""
    values = _long(steps, columns).where(_finite(F.col("value")))
    ends = values.groupBy("kind", "dim").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    same = F.col("low") == F.col("high")
    ends = ends.select("kind", "dim", F.when(same, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"), F.when(same, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"))
    # a row for each dimension of the declared vectors; Spark's estimate would send the values
    binned = values.join(F.broadcast(ends), ["kind", "dim"]).withColumn("bin", bin_of(F.col("value"), F.col("low"), F.col("high"), bins))
    return binned.groupBy("kind", "dim", "bin").agg(F.count("*").alias("n"))


def vector_nonfinite(steps: DataFrame, columns: list[str]) -> DataFrame:
    return _long(steps, columns).groupBy("kind", "dim").agg(F.count_if(~_finite(F.col("value")) | F.col("value").isNull()).alias("n_nonfinite"))


def _finite(v: Column) -> Column:
    return ~F.isnan(v) & (F.abs(v) != float("inf"))


def strided(steps: DataFrame, step: int, index: str = "step_index") -> DataFrame:
    """Every ``step``-th step of each episode."""
    return steps.where(F.col(index) % step == 0)


def captions(steps: DataFrame, keys: list[str], text: str, step: int = 4, index: str = "step_index") -> DataFrame:
    """Each episode's caption: the text of its last step and a remark on the sampling."""
    last = F.max_by(text, index)
    # fixed value: the remark
    return steps.groupBy(*keys).agg(F.concat(last, F.lit(f" (temp. downsampled {step}x)")).alias("caption"))


def preview(steps: DataFrame, keys: list[str], image: str, text: str, shape: tuple[int, int, int], n: int = 5, seed: int = 0, step: int = 4, index: str = "step_index") -> DataFrame:
    """Strips of every ``step``-th image of ``n`` sampled episodes, with captions. Images
    are gathered for ``n`` episodes only."""
    from .sample import sampled_steps

    few = sampled_steps(steps, keys, n, seed)
    frames = strided(few, step, index).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(index, image))).alias("frames"))
    strips = frames.select(*keys, F.size("frames").alias("n_frames"), strip(F.col(f"frames.{image}"), shape).alias("strip"))
    return strips.join(captions(few, keys, text, step, index), keys)


def last_step(steps: DataFrame, keys: list[str], index: str = "step_index") -> DataFrame:
    """The last step of each episode."""
    n = F.max(index).over(Window.partitionBy(*keys))
    return steps.withColumn("last_index", n).where(F.col(index) == F.col("last_index")).drop("last_index")

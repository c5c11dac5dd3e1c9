"""Episodes as flat step tables: position, flags, nesting, keys and counts.

A step table has one row for each step, the episode's key columns and a ``step_index``.
Flat tables prune columns, which nested ones often do not; nested episodes are a view.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

INDEX = "step_index"


def index_steps(df: DataFrame, keys: list[str], order: list[str | Column], name: str = INDEX) -> DataFrame:
    """Adds each step's position, from 0. ``order`` must be total within an episode; see
    ``order_ties``."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long") - 1)


def order_ties(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Places of an episode that several rows claim. Empty if the order is total."""
    return df.groupBy(*keys, *order).agg(F.count("*").alias("n")).where("n > 1")


def derive_flags(df: DataFrame, keys: list[str], index: str = INDEX, demo: bool = True) -> DataFrame:
    """n_steps, is_first, is_last, is_terminal, reward and discount from the position: one
    window over the episode, so one exchange together with ``index_steps``. In a
    demonstration the last step is terminal and has reward 1."""
    n = F.count("*").over(Window.partitionBy(*keys))
    out = df.withColumn("n_steps", n)
    is_last = F.col(index) == F.col("n_steps") - 1
    return out.withColumns(
        {
            "is_first": F.col(index) == 0,
            "is_last": is_last,
            "is_terminal": is_last & F.lit(demo),
            "reward": (is_last & F.lit(demo)).cast("float"),
            "discount": F.lit(1.0).cast("float"),
        }
    )


def flags_nested(steps: Column, demo: bool = True) -> Column:
    """The same fields within an array of step structs, without a shuffle."""
    n = F.size(steps)

    def one(s: Column, i: Column) -> Column:
        is_last = i == n - 1
        return F.struct(
            s.alias("step"),
            (i == 0).alias("is_first"),
            is_last.alias("is_last"),
            (is_last & F.lit(demo)).alias("is_terminal"),
            (is_last & F.lit(demo)).cast("float").alias("reward"),
            F.lit(1.0).cast("float").alias("discount"),
        )

    return F.transform(steps, one)


def nest(steps: DataFrame, keys: list[str], episodes: DataFrame | None = None, index: str = INDEX, name: str = "steps") -> DataFrame:
    """One row for each episode with its steps in order. Episodes without a step stay if
    ``episodes`` names them (with their other columns). An episode is one row here: nest
    what fits in a row, as the interchange format asks, not whole tables of images."""
    fields = [c for c in steps.columns if c not in keys and c != index]
    out = steps.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(index, *fields))).alias(name))
    if episodes is None:
        return out
    kind = out.schema[name].dataType.simpleString()
    return episodes.join(out, keys, "left").withColumn(name, F.coalesce(name, F.expr(f"cast(array() as {kind})")))


def unnest(episodes: DataFrame, keys: list[str], name: str = "steps", index: str = INDEX, outer: bool = False) -> DataFrame:
    """The flat steps, with their position. ``outer`` keeps episodes without a step, as a
    row of nulls."""
    explode = F.posexplode_outer if outer else F.posexplode
    flat = episodes.select(*keys, explode(name).alias(index, "s"))
    inner = [f.name for f in episodes.schema[name].dataType.elementType.fields if f.name != index]
    return flat.select(*keys, F.col(index).cast("long"), *[F.col("s")[c].alias(c) for c in inner])


def attach(steps: DataFrame, episodes: DataFrame, keys: list[str], fields: dict[str, str], name: str = "episode_metadata") -> DataFrame:
    """Episode-level fields as a struct on each step."""
    meta = episodes.select(*keys, F.struct(*[F.col(c).alias(a) for a, c in fields.items()]).alias(name))
    return steps.join(meta, keys)


def zero_step_episodes(episodes: DataFrame, steps: DataFrame, keys: list[str]) -> DataFrame:
    return episodes.join(steps.select(*keys).distinct(), keys, "left_anti")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def require_unique(df: DataFrame, keys: list[str], show: int = 20) -> DataFrame:
    """``df``, or an error that names some of the keys that occur more than once."""
    found = duplicate_keys(df, keys).limit(show).collect()
    if found:
        raise ValueError(f"duplicate keys: {[tuple(r)[:-1] for r in found]}")
    return df


def skip(df: DataFrame, keep: Column) -> tuple[DataFrame, DataFrame]:
    """The rows to keep, and one row with the number of rows that were skipped. A null
    condition skips."""
    ok = F.coalesce(keep, F.lit(False))
    return df.where(ok), df.agg(F.count_if(~ok).alias("skipped"))


def skip_in_pass(df: DataFrame, keep: Column) -> tuple[DataFrame, Observation]:
    """The rows to keep, and counts (``kept``, ``skipped``) that Spark takes while they are
    written, in the same pass. The counts are there after the first action on the rows."""
    seen, ok = Observation(), F.coalesce(keep, F.lit(False))
    return df.observe(seen, F.count_if(ok).alias("kept"), F.count_if(~ok).alias("skipped")).where(ok), seen


def summary(steps: DataFrame, keys: list[str], split: str = "split", size: Column | None = None) -> DataFrame:
    """Episodes, steps and bytes of each split; two stages, so a large split is no large
    task."""
    per_episode = steps.groupBy(split, *keys).agg(F.count("*").alias("n"), F.sum(size if size is not None else F.lit(0)).alias("b"))
    return per_episode.groupBy(split).agg(F.count("*").alias("n_episodes"), F.sum("n").alias("n_steps"), F.sum("b").cast("long").alias("n_bytes"))

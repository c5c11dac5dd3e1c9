"""Positions and flags of steps in episodes of any length.

A window over an episode puts all of it into one task. Here steps are range-partitioned by
episode *and* order, so a long episode is dealt to many tasks, each of which numbers the runs
of its own sorted rows as they stream by. What a task cannot know is how many steps of its
first episode came before, and whether its last one goes on: that follows from two rows of
each partition, which go to the driver, and comes back as a table of one row a partition.

The numbered rows are staged between the two passes, as a partitioning made anew would put the
borders elsewhere. One exchange in all.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.store import new_folder

#: Of a row: its partition, its place there, its place in the episode's run there, if that run
#: is the partition's first, if the row is the partition's last, if it is its run's last.
_MARKS = "q_part int, q_at long, q_place long, q_first_run boolean, q_end boolean, q_run_end boolean"


def _changes(column: pa.Array, before: pa.Scalar | None) -> np.ndarray:
    """Where a value differs from the one before it. Nulls are equal to each other, and NaNs."""
    if before is not None:
        column = pa.concat_arrays([pa.array([before.as_py()], column.type), column])
    a, b = column[1:], column[:-1]
    differ = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
    missing = column.is_null().to_numpy(zero_copy_only=False)
    if pa.types.is_floating(column.type):
        nan = pc.fill_null(pc.is_nan(column), False).to_numpy(zero_copy_only=False)
        differ = differ & ~(nan[1:] & nan[:-1])
    differ = differ | (missing[1:] != missing[:-1])
    return differ if before is not None else np.append(True, differ)


def _marked(batches: Iterator[pa.RecordBatch], keys: list[int]) -> Iterator[pa.RecordBatch]:
    """Adds _MARKS to the rows of one sorted partition. The last row of a batch waits for the
    next batch, which shows if its run ends."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    at, place, runs = 0, -1, 0  # of the rows so far
    last: pa.RecordBatch | None = None  # one row, with its marks but for the last two

    def out(rows: pa.RecordBatch, marks: tuple[np.ndarray, ...], end: np.ndarray, run_end: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(np.full(rows.num_rows, part, np.int32)), *[pa.array(m) for m in marks], pa.array(end), pa.array(run_end)]
        return pa.RecordBatch.from_arrays([*rows.columns, *columns], [*rows.schema.names, *[m.split()[0] for m in _MARKS.split(", ")]])

    kept: tuple[np.ndarray, ...] = ()
    for b in batches:
        if not b.num_rows:
            continue
        new = np.zeros(b.num_rows, bool)
        for k in keys:
            new |= _changes(b.column(k), None if last is None else last.column(k)[0])
        if last is None:
            new[0] = True
        begins = np.flatnonzero(new)
        here = np.arange(b.num_rows)
        run = np.cumsum(new)
        start = np.append(-1, begins)[run]  # of each row's run in this batch, or -1 if it began before
        places = np.where(run > 0, here - start, place + 1 + here)
        numbers = at + here
        first = runs + run == 1
        if last is not None:
            yield out(last, kept, np.array([False]), new[:1])
        if b.num_rows > 1:
            yield out(b.slice(0, b.num_rows - 1), (numbers[:-1], places[:-1], first[:-1]), np.zeros(b.num_rows - 1, bool), new[1:])
        last, kept = b.slice(b.num_rows - 1), (numbers[-1:], places[-1:], first[-1:])
        at, place, runs = at + b.num_rows, int(places[-1]), runs + int(run[-1])
    if last is not None:
        yield out(last, kept, np.array([True]), np.array([True]))


def _borders(rows: list, keys: Sequence[str]) -> list[tuple[int, int, bool]]:
    """part, steps of its first episode before it, and if its last episode goes on; from the
    first and last rows of the partitions."""
    begins = {r["q_part"]: r for r in rows if r["q_at"] == 0}
    ends = {r["q_part"]: r for r in rows if r["q_end"]}
    key = lambda r: tuple("NaN" if r[k] != r[k] else r[k] for k in keys)
    out, of, so_far = [], None, 0  # the episode at the border, and its steps until there
    parts = sorted(begins)
    for p, following in zip(parts, [*parts[1:], None], strict=False):
        before = so_far if of == key(begins[p]) else 0
        end = ends[p]
        so_far = end["q_place"] + 1 + (before if end["q_first_run"] else 0)
        of = key(end)
        out.append((p, before, following is not None and key(begins[following]) == of))
    return out


def place_steps(df: DataFrame, keys: list[str], order: list[str], index: str = "step_index", demo: bool = True, parts: int | None = None) -> DataFrame:
    """``df`` with each step's position (from 0), is_first, is_last, is_terminal, reward and
    discount, as ``episodes.index_steps`` and ``derive_flags`` give them.

    ``order`` must be total within an episode. ``parts``: of the range partitioning; by default
    Spark's number of shuffle partitions, with small ones joined. All columns are staged, so
    give it those that are needed. Rows of null keys are an episode, as in a group."""
    taken = [m.split()[0] for m in _MARKS.split(", ")]
    if clash := set(taken) & {c.lower() for c in df.columns}:
        raise ValueError(f"reserved column names: {sorted(clash)}")
    spark, by = df.sparkSession, [F.col(c).asc_nulls_first() for c in [*keys, *order]]
    at = [df.columns.index(k) for k in keys]
    dealt = df.repartitionByRange(parts, *by) if parts else df.repartitionByRange(*by)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + [_MARKS])
    marked = dealt.sortWithinPartitions(*by).mapInArrow(lambda batches: _marked(batches, at), schema)
    path = new_folder(spark, "positions")
    marked.write.parquet(path)
    stored = spark.read.schema(marked.schema).parquet(path)
    rows = stored.where("q_at = 0 OR q_end").select("q_part", "q_at", "q_place", "q_first_run", "q_end", *keys).collect()  # two a partition
    borders = F.broadcast(spark.createDataFrame(_borders(rows, keys), "q_part int, q_before long, q_goes_on boolean"))
    place = F.col("q_place") + F.when(F.col("q_first_run"), F.col("q_before")).otherwise(0)
    is_last = F.col("q_run_end") & ~(F.col("q_end") & F.col("q_goes_on"))
    out = stored.join(borders, "q_part").withColumns({index: place, "is_last": is_last})
    out = out.withColumns({"is_first": F.col(index) == 0, "is_terminal": F.col("is_last") & F.lit(demo), "reward": (F.col("is_last") & F.lit(demo)).cast("float"), "discount": F.lit(1.0).cast("float")})
    return out.select(*df.columns, index, "is_first", "is_last", "is_terminal", "reward", "discount")


def last_steps(steps: DataFrame, keys: list[str], index: str = "step_index") -> DataFrame:
    """The last step of each episode: lengths are aggregated where the steps are, and the steps
    join on episode and position, of which no two are alike."""
    ends = steps.groupBy(*keys).agg(F.max(index).alias(index))
    on = [F.col(f"s.{c}").eqNullSafe(F.col(f"e.{c}")) for c in [*keys, index]]
    matches = on[0]
    for x in on[1:]:
        matches = matches & x
    return steps.alias("s").join(ends.alias("e"), matches, "left_semi")

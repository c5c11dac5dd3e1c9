"""From source steps to target steps: a projection, and a hook for functions of one step."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.images import resize
from ..functions.vectors import parts

#: Which source dimensions make the target action, and what is copied.
ACTION_SLICES = ((None, 3), (5, 8), (-2, None))
COPIED = ("discount", "reward", "is_first", "is_last", "is_terminal", "language_instruction", "language_embedding")


@dataclass(frozen=True)
class Target:
    slices: tuple[tuple[int | None, int | None], ...] = ACTION_SLICES
    copied: tuple[str, ...] = COPIED
    old: tuple[int, int, int] = (64, 64, 3)
    new: tuple[int, int] = (128, 128)

    def action(self, action: Column) -> Column:
        return parts(action, list(self.slices))

    def apply(self, steps: DataFrame, keys: list[str]) -> DataFrame:
        """All other columns are dropped. Without a use of the image, its resizing is
        pruned from the plan."""
        image = [F.struct(resize(F.col("image"), self.old, self.new).alias("image")).alias("observation")] if "image" in steps.columns else []
        return steps.select(*keys, *image, self.action(F.col("action")).alias("action"), *[c for c in self.copied if c in steps.columns])


def map_steps(steps: DataFrame, function: Callable[[dict], dict | None], schema: StructType) -> DataFrame:
    """``function`` of each step, as a dict; None drops the step. For what has no columns:
    rows go through Python, in Arrow batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [y for x in b.to_dict("records") if (y := function(x)) is not None]
            yield pd.DataFrame(rows, columns=schema.fieldNames())

    return steps.mapInPandas(run, schema)

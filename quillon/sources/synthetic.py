"""Made-up recordings, the same for a seed on any cluster."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf


def _uniform(seed: int, label: str, i: Column, j: Column) -> Column:
    """In [0, 1), a float exactly."""
    return (F.pmod(F.xxhash64(F.lit(seed), F.lit(label), i, j), F.lit(1 << 24)) / F.lit(float(1 << 24))).cast("float")


def episodes(spark: SparkSession, per_split: dict[str, int] | None = None, steps: int = 10, dims: int = 10, seed: int = 0, images: tuple[int, int, int] | None = (64, 64, 3), instruction: str = "dummy instruction") -> DataFrame:
    """split, episode_id, step_index, state, action, language_instruction, and image and
    wrist_image unless ``images`` is None."""
    out = None
    for split, n in (per_split or {"train": 100, "val": 100}).items():
        part = spark.range(n * steps).withColumn("split", F.lit(split))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no split")
    row = F.xxhash64("split", "id")
    vector = lambda label: F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda j: _uniform(seed, label, row, j))
    out = out.select(
        "split",
        F.concat(F.lit("episode_"), F.floor(F.col("id") / steps).cast("string")).alias("episode_id"),
        (F.col("id") % steps).alias("step_index"),
        vector("state").alias("state"),
        vector("action").alias("action"),
        F.lit(instruction).alias("language_instruction"),
        row.alias("row"),
    )
    if images:

        @pandas_udf("binary")
        def pixels(s: pd.Series) -> pd.Series:
            return s.map(lambda x: (np.random.Generator(np.random.PCG64(x % 2**63)).random(images) * 255).astype(np.uint8).tobytes())

        out = out.withColumns({"image": pixels(F.xxhash64("row", F.lit(seed), F.lit("image"))), "wrist_image": pixels(F.xxhash64("row", F.lit(seed), F.lit("wrist")))})
    return out.drop("row")


def uniform(seed: int, label: str, *parts: Column) -> Column:
    """In [0, 1), a float exactly; follows from md5 of seed, label and parts, so other engines
    can make the same."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(label), *[p.cast("string") for p in parts]))
    return (F.conv(F.substring(digest, 1, 6), 16, 10).cast("long") / F.lit(float(1 << 24))).cast("float")


def for_rows(rows: DataFrame, key: str, steps: Column, vectors: dict[str, int], seed: int = 0, image: tuple[int, int, int] | None = None) -> DataFrame:
    """An episode of ``steps`` steps for each row of a table: its key, step_index, uniform
    vectors of the given sizes, and with ``image`` pixels of that shape, whose bytes are values
    times 255, cut off. The same for a seed on any cluster. A null number of steps is none."""
    many = F.coalesce(steps, F.lit(0)).cast("int")
    index = F.explode(F.when(many > 0, F.sequence(F.lit(0), many - 1)).otherwise(F.array().cast("array<int>")))
    out = rows.select(F.col(key), index.alias("step_index"))
    vector = lambda label, n: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda j: uniform(seed, label, F.col(key), F.col("step_index"), j))
    made = {name: vector(name, n) for name, n in vectors.items()}
    if image:
        h, w, c = image
        byte = lambda x: F.lpad(F.hex(F.floor(x.cast("double") * 255).cast("long")), 2, "0")
        made["image"] = F.unhex(F.array_join(F.transform(vector("image", h * w * c), byte), ""))
    return out.select(key, F.col("step_index").cast("long").alias("step_index"), *[v.alias(k) for k, v in made.items()])

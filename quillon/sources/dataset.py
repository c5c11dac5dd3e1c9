"""Datasets on disk: flat steps and episodes by split, and a log of versions.

    path/data/<id>/steps/split=.../    of each version, with Spark's own files
    path/data/<id>/episodes/split=.../
    path/log/00000001.json             what version 1 is: its data, schema, counts and notes

A version exists when its entry in the log does. The entry is made last, in one rename, so
steps, episodes and facts become visible together, a write that is killed leaves what was
there, and of two writers at a time one gets an error (where the store renames in one step, as HDFS and
mounted folders do; on a plain object store, let one write at a time). Old versions stay readable until
``vacuum``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.images import decode_png, encode_columns
from ..operators.episodes import require_unique
from ..plans.schema import EpisodeSchema
from .store import Files

KEYS = ["split", "episode_id"]

Adapter = Callable[[SparkSession], DataFrame]


def splits(parts: dict[str, DataFrame]) -> DataFrame:
    """One table of the named splits; each is an adapter's flat steps."""
    out = None
    for name, df in parts.items():
        df = df.withColumn("split", F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("no split")
    return out


def declared(steps: DataFrame, schema: EpisodeSchema) -> DataFrame:
    """The columns of the schema with its metadata, in its order. Missing ones are an error;
    others are dropped."""
    fields = schema.flat().fields
    missing = [f.name for f in fields if f.name not in steps.columns]
    if missing:
        raise ValueError(f"missing features: {missing}")
    return steps.select(*[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in fields])


def encoded(steps: DataFrame) -> DataFrame:
    """Declared steps, whose columns of pixels are in the encoding that they declare."""
    shapes = {f.name: tuple(f.metadata["shape"]) for f in steps.schema if f.metadata.get("encoding") == "png"}
    out = encode_columns(steps, shapes) if shapes else steps
    return out.select(*[F.col(f.name).alias(f.name, metadata=f.metadata) for f in steps.schema])


def pixels(steps: DataFrame) -> DataFrame:
    """Stored steps with pixels instead of encoded images. A column that is not used later is
    not decoded."""
    raw = {f.name: {**f.metadata, "encoding": ""} for f in steps.schema if f.metadata.get("encoding") == "png"}
    return steps.select(*[decode_png(F.col(c)).alias(c, metadata=raw[c]) if c in raw else F.col(c) for c in steps.columns])


@dataclass(frozen=True)
class Version:
    """An entry of the log."""

    number: int
    data: str
    name: str
    version: str
    release_notes: str
    description: str = ""
    citation: str = ""
    licence: str = ""
    schema: dict = field(default_factory=dict)
    splits: dict[str, dict[str, int]] = field(default_factory=dict)


def versions(spark: SparkSession, path: str) -> list[int]:
    return [int(x[:-5]) for x in Files(spark, path).names("log") if x.endswith(".json") and x[:-5].isdigit()]


def version(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """An entry of the log, the last by default."""
    have = versions(spark, path)
    if not have or number is not None and number not in have:
        raise FileNotFoundError(f"{path} has no {'version' if number is None else f'version {number}'}; there are {have}")
    return Version(**json.loads(Files(spark, path).read(f"log/{number if number is not None else have[-1]:08d}.json")))


def _counted(steps: DataFrame, names: Sequence[str], size: Column) -> tuple[DataFrame, Observation]:
    """``steps``, and counts of steps and bytes that Spark takes as they pass."""
    seen = Observation()
    of = [(i, F.col("split") == name) for i, name in enumerate(names)]
    counts = [x for i, here in of for x in (F.count_if(here).alias(f"n{i}"), F.coalesce(F.sum(F.when(here, size)), F.lit(0)).cast("long").alias(f"b{i}"))]
    return steps.observe(seen, *counts, F.count_if(F.coalesce(~F.col("split").isin(*names), F.lit(True))).alias("other")), seen


def write(steps: DataFrame, path: str, schema: EpisodeSchema, episodes: DataFrame | None = None, names: Sequence[str] = ("train", "val"), overwrite: bool = False, description: str = "", citation: str = "", licence: str = "") -> Version:
    """Write a version of the dataset and return it. ``names`` are the splits that there are;
    a step of another is an error. Step keys, and those of ``episodes`` (which keeps episodes
    without a step), must be unique. Without ``overwrite`` there must be no version yet.

    Images are stored as their features say. The steps are computed once: counts are taken as they are written, and keys are compared
    on the written columns."""
    spark, files, before = steps.sparkSession, Files(steps.sparkSession, path), versions(steps.sparkSession, path)
    if before and not overwrite:
        raise FileExistsError(f"{path} already exists, as version {before[-1]}")
    own = f"data/{uuid.uuid4().hex}"
    try:
        size = sum((F.coalesce(F.octet_length(f.name), F.lit(0)) for f in schema.steps if f.kind == "uint8"), F.lit(0))
        out, seen = _counted(encoded(declared(steps, schema)), names, size)
        out.write.partitionBy("split").parquet(f"{path}/{own}/steps")
        there = seen.get
        if there["other"]:
            raise ValueError(f"{there['other']} steps are of no split of {list(names)}")
        written = spark.read.schema(schema.flat()).parquet(f"{path}/{own}/steps")
        require_unique(written, [*KEYS, "step_index"])
        counted = written.groupBy(*KEYS).agg(F.count("*").alias("n_steps"))
        listed = counted
        if episodes is not None:
            listed = episodes.drop("n_steps").join(counted, KEYS, "full").withColumn("n_steps", F.coalesce("n_steps", F.lit(0)))
            require_unique(episodes, KEYS)
        listed, also = _counted(listed, names, F.lit(0))
        listed.write.partitionBy("split").parquet(f"{path}/{own}/episodes")
        facts = {n: {"n_episodes": also.get[f"n{i}"], "n_steps": there[f"n{i}"], "n_bytes": there[f"b{i}"]} for i, n in enumerate(names)}
        entry = Version((before[-1] if before else 0) + 1, own, path.rstrip("/").rsplit("/", 1)[-1], schema.version, schema.notes, description, citation, licence, json.loads(schema.flat().json()), facts)
        if not files.publish(f"log/{entry.number:08d}.json", json.dumps(asdict(entry))):
            raise FileExistsError(f"another writer made version {entry.number} of {path}")
    except BaseException:
        files.delete(own)
        raise
    return entry


def read(spark: SparkSession, path: str, split: str | None = None, table: str = "steps", number: int | None = None) -> DataFrame:
    """A table of a version, the last by default. A split is a partition of the files: others
    are not read. Images are decoded where they are used."""
    df = spark.read.parquet(f"{path}/{version(spark, path, number).data}/{table}")
    return pixels(df.where(F.col("split") == split) if split else df)


def summary(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """Episodes, steps and bytes of each split, as the log has them: nothing is read."""
    facts = version(spark, path, number).splits
    return spark.createDataFrame([(n, x["n_episodes"], x["n_steps"], x["n_bytes"]) for n, x in facts.items()], "split string, n_episodes long, n_steps long, n_bytes long")


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> list[int]:
    """Drops all versions but the last ``keep``, and data that no version names, as killed
    writes leave it. Not while others write. Returns the dropped versions."""
    files, have = Files(spark, path), versions(spark, path)
    gone = have[:-keep] if keep else have
    stay = {version(spark, path, n).data for n in have if n not in gone}
    for n in gone:
        files.delete(f"log/{n:08d}.json")
    for name in files.names("data"):
        if f"data/{name}" not in stay:
            files.delete(f"data/{name}")
    return gone


# --- names

_registry: dict[str, str] = {}


def register(name: str, path: str) -> None:
    """A name for this process; ``Catalogue`` keeps names for all."""
    _registry[name] = path


def find(name: str) -> str:
    if name not in _registry:
        raise KeyError(f"unknown dataset {name!r}; known: {sorted(_registry)}")
    return _registry[name]


class Catalogue:
    """Names of datasets, in a folder that processes share: a file for each name and change,
    of which the last counts."""

    def __init__(self, spark: SparkSession, folder: str):
        self._files = Files(spark, folder)

    def register(self, name: str, path: str) -> None:
        if not name or not name.replace("_", "").replace("-", "").isalnum():
            raise ValueError(f"{name!r} is no name: letters, digits, - and _")
        while not self._files.publish(f"{name}/{len(self._files.names(name)) + 1:08d}", path):
            pass

    def find(self, name: str) -> str:
        have = self._files.names(name) if name.replace("_", "").replace("-", "").isalnum() else []
        if not have:
            raise KeyError(f"unknown dataset {name!r}; known: {self.names()}")
        return self._files.read(f"{name}/{have[-1]}")

    def names(self) -> list[str]:
        return self._files.names()

"""The nested view of a dataset and its way back, compiled from the schema.

Flat steps are what is stored. The interchange view has one row for each episode: its steps in
order, each with the observation's features in a struct of their own, and the episode's
metadata in another. Both directions are select lists that follow from ``EpisodeSchema``, so a
feature that is added to or taken from the schema moves in both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.episodes import INDEX
from .schema import EpisodeSchema, Feature

KEYS = ["split", "episode_id"]


def in_observation(feature: Feature) -> bool:
    return feature.kind == "uint8" or feature.name == "state"


def _given(df: DataFrame, feature: Feature, path: str = "") -> Column:
    """The feature's column, or nulls of its type if it may be missing and is."""
    kind = feature.field().dataType
    if path or feature.name in df.columns:
        return F.col(path + feature.name).cast(kind)
    if not feature.optional:
        raise ValueError(f"missing feature: {feature.name}")
    return F.lit(None).cast(kind)


def step_struct(steps: DataFrame, schema: EpisodeSchema) -> Column:
    """One step of the nested view."""
    inside = [f for f in schema.steps if in_observation(f)]
    outside = [f for f in schema.steps if not in_observation(f)]
    observation = [F.struct(*[_given(steps, f).alias(f.name) for f in inside]).alias("observation")] if inside else []
    return F.struct(*observation, *[_given(steps, f).alias(f.name) for f in outside])


def nested_view(steps: DataFrame, schema: EpisodeSchema, episodes: DataFrame | None = None, index: str = INDEX) -> DataFrame:
    """split, episode_id, steps, episode_metadata, of the types that ``schema.nested`` names.
    ``episodes`` has the metadata, and keeps episodes without a step. An episode is one row
    here, so it must fit in one."""
    place = F.col(index).alias("p")
    held = steps.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct(place, step_struct(steps, schema).alias("s")))).alias("steps"))
    step = schema.nested()["steps"].dataType
    if episodes is None:
        meta = F.struct(*[F.lit(None).cast(f.field().dataType).alias(f.name) for f in schema.metadata])
        out = held.withColumn("episode_metadata", meta)
    else:
        meta = F.struct(*[_given(episodes, f).alias(f.name) for f in schema.metadata])
        out = episodes.select(*KEYS, meta.alias("episode_metadata")).join(held, KEYS, "left")
    steps_only = F.coalesce(F.transform("steps", lambda x: x["s"]), F.array().cast(step))
    out = out.select(*KEYS, steps_only.alias("steps"), "episode_metadata")
    return out.to(T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.nested()]))


def flat_view(nested: DataFrame, schema: EpisodeSchema, index: str = INDEX) -> DataFrame:
    """The flat steps of a nested view, with the schema's metadata. Features that the schema
    does not name are dropped, ones that the view does not have are an error."""
    flat = nested.select(*KEYS, F.posexplode("steps").alias(index, "s"))
    inner = nested.schema["steps"].dataType.elementType

    def taken(f: Feature) -> Column:
        path = "s.observation." if in_observation(f) else "s."
        kind = inner["observation"].dataType if in_observation(f) and "observation" in inner.fieldNames() else inner
        if f.name not in kind.fieldNames():
            raise ValueError(f"the nested view has no {f.name}")
        return F.col(path + f.name).alias(f.name, metadata=f.field().metadata)

    return flat.select(*KEYS, F.col(index).cast("long").alias(index), *[taken(f) for f in schema.steps])


def episode_view(nested: DataFrame, schema: EpisodeSchema) -> DataFrame:
    """One row for each episode: keys, metadata and number of steps."""
    return nested.select(*KEYS, *[F.col(f"episode_metadata.{f.name}") for f in schema.metadata], F.size("steps").cast("long").alias("n_steps"))

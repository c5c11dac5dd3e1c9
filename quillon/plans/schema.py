"""The declared schema of an episode dataset.

A feature has a type, a shape, an encoding and a description, which travel in the metadata
of a ``StructField`` (and survive Parquet). Parquet forgets that a column is required and
how long its arrays are, so ``spec.Spec`` enforces these.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

TYPES = {"uint8": T.BinaryType(), "float32": T.ArrayType(T.FloatType()), "float": T.FloatType(), "bool": T.BooleanType(), "text": T.StringType()}


@dataclass(frozen=True)
class Feature:
    name: str
    kind: str  # of TYPES
    doc: str
    shape: tuple[int, ...] = ()
    encoding: str = ""
    optional: bool = False

    def field(self) -> T.StructField:
        if not self.doc:
            raise ValueError(f"{self.name}: a feature must be described")
        return T.StructField(self.name, TYPES[self.kind], True, {"shape": list(self.shape), "encoding": self.encoding, "doc": self.doc, "kind": self.kind})


#: The fields of the source format.
STEP_FEATURES = (
    Feature("image", "uint8", "Main camera, RGB.", (64, 64, 3), "png"),
    Feature("wrist_image", "uint8", "Wrist camera, RGB.", (64, 64, 3), "png", True),
    Feature("state", "float32", "7 joint angles, 2 gripper positions, 1 door angle.", (10,), "", True),
    Feature("action", "float32", "7 joint velocities, 2 gripper velocities, 1 terminate.", (10,)),
    Feature("discount", "float", "Discount, 1 by default."),
    Feature("reward", "float", "Reward, 1 on the last step of a demonstration."),
    Feature("is_first", "bool", "First step of the episode."),
    Feature("is_last", "bool", "Last step of the episode."),
    Feature("is_terminal", "bool", "Last step, if it is terminal; true for demonstrations."),
    Feature("language_instruction", "text", "Instruction."),
    Feature("language_embedding", "float32", "Embedding of the instruction.", (512,)),
)
EPISODE_FEATURES = (Feature("file_path", "text", "Path of the original file."),)


@dataclass(frozen=True)
class EpisodeSchema:
    steps: tuple[Feature, ...] = STEP_FEATURES
    metadata: tuple[Feature, ...] = EPISODE_FEATURES
    version: str = "1.0.0"
    notes: str = "Initial release."

    def with_feature(self, feature: Feature, level: str = "steps") -> EpisodeSchema:
        have = getattr(self, level)
        if any(f.name == feature.name for f in have):
            raise ValueError(f"{feature.name} is there already")
        return replace(self, **{level: (*have, feature)})

    def without_feature(self, name: str) -> EpisodeSchema:
        found = [f for f in self.steps if f.name == name]
        if not found:
            raise KeyError(name)
        if not found[0].optional and any(f.name == name for f in STEP_FEATURES):
            raise ValueError(f"{name} is mandatory")
        return replace(self, steps=tuple(f for f in self.steps if f.name != name))

    def flat(self) -> T.StructType:
        keys = [T.StructField("split", T.StringType()), T.StructField("episode_id", T.StringType()), T.StructField("step_index", T.LongType())]
        return T.StructType([*keys, *[f.field() for f in self.steps]])

    def nested(self) -> T.StructType:
        """The interchange view: observation fields in a struct of their own."""
        inside = [f for f in self.steps if f.kind == "uint8" or f.name == "state"]
        step = T.StructType([T.StructField("observation", T.StructType([f.field() for f in inside])), *[f.field() for f in self.steps if f not in inside]])
        return T.StructType(
            [
                T.StructField("split", T.StringType()),
                T.StructField("episode_id", T.StringType()),
                T.StructField("steps", T.ArrayType(step)),
                T.StructField("episode_metadata", T.StructType([f.field() for f in self.metadata])),
            ]
        )

"""python -m quillon.cli build|validate|profile ..."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions.embed import HashEmbedder, embed_in_place
from .operators import dense
from .operators.sample import sampled_steps
from .plans.schema import EpisodeSchema
from .plans.spec import TARGET, violations
from .plans.transform import Target
from .sources import dataset, npy


def build(spark: SparkSession, a: argparse.Namespace) -> int:
    """Flags follow where a recording is decoded, so images meet no shuffle."""
    given = dict(x.split("=", 1) for x in a.split)
    steps = dataset.splits({k: npy.read(spark, v, npy.ALL) for k, v in given.items()}).drop("n_steps")
    paths = dataset.splits({k: npy.episode_paths(spark, v) for k, v in given.items()})
    texts = dataset.splits({k: npy.read(spark, v, ["language_instruction"]) for k, v in given.items()})
    steps = embed_in_place(steps, texts, "language_instruction", HashEmbedder(), "language_embedding")
    made = dataset.write(steps, a.out, EpisodeSchema(), paths, list(given), a.overwrite)
    if a.name:
        dataset.Catalogue(spark, a.catalogue).register(a.name, a.out)
    print(f"version {made.number}")
    dataset.summary(spark, a.out).show(truncate=False)
    return 0


def _found(spark: SparkSession, a: argparse.Namespace) -> str:
    """The dataset's path, which is given or has a name in the catalogue."""
    return dataset.Catalogue(spark, a.catalogue).find(a.dataset) if a.catalogue and "/" not in a.dataset else a.dataset


def validate(spark: SparkSession, a: argparse.Namespace) -> int:
    steps = dataset.read(spark, _found(spark, a), a.split, number=a.version)
    if a.episodes:
        steps = sampled_steps(steps, dataset.KEYS, a.episodes, a.seed)
    bad = violations(Target().apply(steps, [*dataset.KEYS, "step_index"]), TARGET, [*dataset.KEYS, "step_index"])
    found = bad.groupBy("field", "check").count().orderBy("field", "check").collect()
    for r in found:
        print(f"{r['field']}: {r['check']} fails for {r['count']} steps")
    print("failed" if found else "passed")
    return int(bool(found))


def profile(spark: SparkSession, a: argparse.Namespace) -> int:
    steps = dataset.read(spark, _found(spark, a), a.split, number=a.version)
    if a.episodes:
        steps = sampled_steps(steps, dataset.KEYS, a.episodes, a.seed)
    dense.means(steps, ["action", "state"]).orderBy("kind", "dim").show(200)
    dense.histogram(steps, ["action", "state"]).groupBy("kind", "dim").agg(F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("bins")).orderBy("kind", "dim").show(200, truncate=False)
    return 0


def main(arguments: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="quillon")
    commands = p.add_subparsers(dest="command", required=True)
    b = commands.add_parser("build")
    b.add_argument("out")
    b.add_argument("--split", action="append", required=True, help="name=glob of NPY recordings")
    b.add_argument("--overwrite", action="store_true", help="make a new version")
    b.add_argument("--name", default=None, help="for the catalogue")
    b.add_argument("--catalogue", default=None, help="folder of the catalogue")
    for name in ("validate", "profile"):
        c = commands.add_parser(name)
        c.add_argument("dataset", help="a path, or a name in the catalogue")
        c.add_argument("--catalogue", default=None, help="folder of the catalogue")
        c.add_argument("--version", type=int, default=None)
        c.add_argument("--split", default=None)
        c.add_argument("--episodes", type=int, default=0, help="of a seeded sample; 0 is all")
        c.add_argument("--seed", type=int, default=0)
    a = p.parse_args(arguments)
    if a.command == "build" and a.name and not a.catalogue:
        p.error("--name needs a --catalogue")
    spark = SparkSession.builder.appName("quillon").getOrCreate()
    return {"build": build, "validate": validate, "profile": profile}[a.command](spark, a)


if __name__ == "__main__":
    sys.exit(main())

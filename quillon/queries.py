"""The library's operators as queries over the relational tables, with equivalent SQL.

Views that make episodes of tables:

* ``conversation_steps``: an episode for each conversation, a step for each turn;
* ``order_steps``: an episode for each order, a step for each of its lines, with an action
  of ten normalised measures;
* ``event_steps``: an episode for each user, a step for each event;
* ``embeddings``: one vector for each row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .functions import embed, images, lexical, vectors
from .operators import dense, episodes, positions, profile, sample
from .plans import nesting
from .plans import spec as specs
from .plans.schema import STEP_FEATURES, EpisodeSchema, Feature
from .plans.transform import ACTION_SLICES, COPIED, Target, map_steps
from .sources import dataset, npy, synthetic, tfrecord
from .sources.store import new_folder

ORDER_KEY = ["l_orderkey"]
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]
#: Measures of a line, as SQL that both engines read alike. Adding 0 turns -0.0 to 0.0.
MEASURES = (
    "l_quantity / 50e0", "l_extendedprice / 100000e0", "l_discount + 0e0", "l_tax + 0e0", "cast(l_linenumber as double) / 7e0",
    "(l_quantity - 25e0) / 4e0", "l_extendedprice / 10000e0", "l_discount * 10e0 + 0e0", "l_tax * 10e0 + 0e0", "case when l_linestatus = 'O' then 1e0 else 0e0 end",
)
#: The dimensions that the slices of ``ACTION_SLICES`` take of ten.
TAKEN = (0, 1, 2, 5, 6, 7, 8, 9)
STATE = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def conversation_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "conversations")
    return t.select("conv_id", F.col("turn").alias("step_index"), "role", F.col("text").alias("language_instruction"))


def split_of(key: str) -> Column:
    return F.when(F.col(key) % 10 == 0, "val").otherwise("train")


def order_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = episodes.index_steps(table(spark, sf_dir, "lineitem"), ORDER_KEY, LINE_ORDER)
    action = F.array(*[F.expr(f"cast({m} as float)") for m in MEASURES])
    state = F.array(*[F.col(c) + 0.0 for c in STATE])
    return lines.withColumns({"action": action, "state": state})


def flagged_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return episodes.derive_flags(conversation_steps(spark, sf_dir), ["conv_id"])


# --- positions


def step_index(spark, sf_dir):
    return order_steps(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "step_index")


def episode_length(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n_steps"))


def first_last_terminal(spark, sf_dir):
    return flagged_conversations(spark, sf_dir).select("conv_id", "step_index", "is_first", "is_last", "is_terminal")


def terminal_reward(spark, sf_dir):
    return flagged_conversations(spark, sf_dir).select("conv_id", "step_index", "reward", "discount")


def temporal_stride(spark, sf_dir):
    return profile.strided(conversation_steps(spark, sf_dir), 4)


def last_instruction_caption(spark, sf_dir):
    return profile.captions(conversation_steps(spark, sf_dir), ["conv_id"], "language_instruction")


def last_step(spark, sf_dir):
    return profile.last_step(conversation_steps(spark, sf_dir), ["conv_id"])


def _one_long_episode(spark, sf_dir) -> DataFrame:
    """Half of all events are one user's."""
    t = table(spark, sf_dir, "events")
    return t.select(F.when(F.col("event_id") % 2 == 0, -1).otherwise(F.col("user_id")).cast("long").alias("user_id"), "ts", "event_id", "event_type")


def long_episode_flags(spark, sf_dir):
    out = positions.place_steps(_one_long_episode(spark, sf_dir), ["user_id"], ["ts", "event_id"])
    return out.select("user_id", "event_id", "step_index", "is_first", "is_last", "is_terminal", "reward", "discount")


def long_last_step(spark, sf_dir):
    placed = positions.place_steps(_one_long_episode(spark, sf_dir), ["user_id"], ["ts", "event_id"])
    return positions.last_steps(placed, ["user_id"]).select("user_id", "event_id", "step_index", "event_type")


# --- nesting, keys, splits


def nest_unnest_roundtrip(spark, sf_dir):
    steps = order_steps(spark, sf_dir).select("l_orderkey", "step_index", "l_partkey", "l_quantity")
    return episodes.unnest(episodes.nest(steps, ORDER_KEY), ORDER_KEY)


def nested_flags(spark, sf_dir):
    nested = episodes.nest(conversation_steps(spark, sf_dir), ["conv_id"])
    flat = nested.select("conv_id", F.explode(episodes.flags_nested(F.col("steps"))).alias("s"))
    return flat.select("conv_id", F.col("s.step.step_index").alias("step_index"), "s.is_first", "s.is_last", "s.is_terminal", "s.reward", "s.discount")


def episode_metadata(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    joined = episodes.attach(lines, orders, ORDER_KEY, {"priority": "o_orderpriority", "order_date": "o_orderdate"})
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "episode_metadata.priority", "episode_metadata.order_date")


def zero_step_episodes(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return episodes.zero_step_episodes(orders, table(spark, sf_dir, "lineitem"), ORDER_KEY)


def empty_episodes_nested(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    steps = order_steps(spark, sf_dir).select("l_orderkey", "step_index", "l_quantity")
    return episodes.nest(steps, ORDER_KEY, orders).select("l_orderkey", F.size("steps").cast("long").alias("n_steps"))


def duplicate_keys(spark, sf_dir):
    return episodes.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def skip_examples(spark, sf_dir):
    return episodes.skip(table(spark, sf_dir, "events"), F.col("value") >= 10)[0].select("event_id", "user_id", "event_type", "value")


def skipped_count(spark, sf_dir):
    return episodes.skip(table(spark, sf_dir, "events"), F.col("value") >= 10)[1]


def split_assign(spark, sf_dir):
    steps = conversation_steps(spark, sf_dir).withColumn("split", split_of("conv_id"))
    return episodes.summary(steps, ["conv_id"]).select("split", "n_episodes", "n_steps")


def dataset_summary(spark, sf_dir):
    steps = conversation_steps(spark, sf_dir).withColumn("split", split_of("conv_id"))
    return episodes.summary(steps, ["conv_id"], size=F.octet_length("language_instruction"))


def event_index(spark, sf_dir):
    return episodes.index_steps(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "step_index")


# --- vectors and the target


def _slice(spark, sf_dir, start, stop, n):
    t = table(spark, sf_dir, "embeddings")
    return t.select("vec_id", *vectors.unnested(vectors.part(F.col("embedding"), start, stop), [f"e{i}" for i in range(n)]))


def slice_head(spark, sf_dir):
    return _slice(spark, sf_dir, None, 3, 3)


def slice_mid(spark, sf_dir):
    return _slice(spark, sf_dir, 5, 8, 3)


def slice_tail(spark, sf_dir):
    return _slice(spark, sf_dir, -2, None, 2)


def slice_stride(spark, sf_dir):
    t = table(spark, sf_dir, "embeddings")
    return t.select("vec_id", *vectors.unnested(vectors.every(F.col("embedding"), 4), [f"e{i}" for i in range(16)]))


def target_steps(spark, sf_dir) -> DataFrame:
    return Target(copied=()).apply(order_steps(spark, sf_dir), ["l_orderkey", "step_index"])


def target_action(spark, sf_dir):
    return target_steps(spark, sf_dir).select("l_orderkey", "step_index", *vectors.unnested(F.col("action"), [f"a{i}" for i in range(8)]))


def copy_fields(spark, sf_dir):
    flagged = flagged_conversations(spark, sf_dir).withColumn("language_embedding", F.length("language_instruction").cast("float"))
    return flagged.select("conv_id", "step_index", *COPIED)


# --- checks


EMBEDDING_SPEC: specs.Spec = {"embedding": specs.Leaf("float32", (64,), -0.4, 0.4)}
ACTION_SPEC: specs.Spec = {"action": specs.TARGET["action"]}


def check_shape(spark, sf_dir):
    shape, _ = specs.checks(EMBEDDING_SPEC)
    return table(spark, sf_dir, "embeddings").select("vec_id", shape.ok.alias("ok"))


def check_range_uniform(spark, sf_dir):
    _, range_ = specs.checks(EMBEDDING_SPEC)
    return table(spark, sf_dir, "embeddings").select("vec_id", range_.ok.alias("ok"))


def check_range_per_dim(spark, sf_dir):
    bad = specs.violations(target_steps(spark, sf_dir), ACTION_SPEC, ["l_orderkey", "step_index"])
    return bad.select("l_orderkey", "step_index", F.regexp_extract("field", r"\[(\d+)\]", 1).cast("long").alias("dim"))


def violations_report(spark, sf_dir):
    return specs.report(target_steps(spark, sf_dir), ACTION_SPEC)


def pass_verdict(spark, sf_dir):
    return specs.verdict(target_steps(spark, sf_dir), ACTION_SPEC)


def ragged_vectors(spark, sf_dir):
    t = conversation_steps(spark, sf_dir).withColumn("words", F.split("language_instruction", " "))
    return profile.ragged(t, ["words"]).select("kind", F.col("smallest").cast("long").alias("smallest"), F.col("largest").cast("long").alias("largest"))


# --- profiles and samples


def vector_mean(spark, sf_dir):
    return dense.means(order_steps(spark, sf_dir), ["action", "state"]).select("kind", "dim", F.round("mean", 6).alias("mean"), "n")


def embedding_mean(spark, sf_dir):
    t = table(spark, sf_dir, "embeddings").select("embedding")
    return dense.means(t, ["embedding"]).select("dim", F.round("mean", 6).alias("mean"), "n")


def vector_histogram(spark, sf_dir):
    return dense.histogram(order_steps(spark, sf_dir), ["action", "state"])


def vector_nonfinite(spark, sf_dir):
    t = table(spark, sf_dir, "events").select(F.array("value", F.expr("case when value > 400 then cast('NaN' as double) else value end")).alias("state"))
    return dense.nonfinite(t, ["state"])


def sample_episodes(spark, sf_dir):
    return sample.sample_episodes(conversation_steps(spark, sf_dir), ["conv_id"], 50, 42)


def sampled_steps(spark, sf_dir):
    return sample.sampled_steps(conversation_steps(spark, sf_dir), ["conv_id"], 50, 42).select("conv_id", "step_index", "role")


def hash_embed_distinct(spark, sf_dir):
    e = embed.HashEmbedder(8)
    t = table(spark, sf_dir, "events").select("event_type")
    out = embed.embed_distinct(t, "event_type", e, "vector")
    return out.groupBy("event_type").agg(F.count("*").alias("n"), F.first("vector").alias("v")).select("event_type", "n", F.posexplode("v").alias("dim", "value")).withColumn("dim", F.col("dim").cast("long"))


# --- images

SHAPE = (16, 16, 3)


def _pixels(df: DataFrame, key: str, shape=SHAPE) -> Column:
    """Pixel (31 * key + 7 y + 13 x + 17 c) modulo 256, by a formula, as bytes."""
    h, w, c = shape
    n = F.sequence(F.lit(0), F.lit(h * w * c - 1))
    value = lambda i: (31 * F.col(key) + 7 * F.floor(i / (w * c)) + 13 * F.floor(i % (w * c) / c) + 17 * (i % c)) % 256
    return F.unhex(F.array_join(F.transform(n, lambda i: F.lpad(F.hex(value(i).cast("long")), 2, "0")), ""))


def image_strip(spark, sf_dir):
    steps = conversation_steps(spark, sf_dir)
    steps = steps.withColumn("seed", F.col("conv_id") + F.col("step_index"))
    steps = steps.withColumn("image", _pixels(steps, "seed", (2, 2, 3)))
    out = profile.preview(steps, ["conv_id"], "image", "language_instruction", (2, 2, 3), n=20, seed=1)
    return out.select("conv_id", F.col("n_frames").cast("long").alias("n_frames"), F.lower(F.hex("strip")).alias("strip_hex"), "caption")


def lanczos_resize(spark, sf_dir):
    ids = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("img"))
    out = ids.select("img", images.resize(_pixels(ids, "img"), SHAPE, (32, 32)).alias("bytes"))
    flat = out.select("img", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(32 * 32 * 3 - 1)), lambda i: F.conv(F.hex(F.substring("bytes", i + 1, F.lit(1))), 16, 10).cast("long"))).alias("i", "v"))
    return flat.select("img", F.floor(F.col("i") / 96).alias("y"), F.floor(F.col("i") % 96 / 3).alias("x"), (F.col("i") % 3).cast("long").alias("c"), "v")


def png_roundtrip(spark, sf_dir):
    ids = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("img"))
    pixels = ids.withColumn("image", _pixels(ids, "img"))
    return pixels.select("img", (images.decode_png(images.encode_png(F.col("image"), 16, 16)) == F.col("image")).alias("same"), F.length("image").cast("long").alias("n_bytes"))


#: The source's and the target's real shapes.
SOURCE, TARGET = (64, 64, 3), (128, 128, 3)


def _frames(seed: Column, shape: tuple[int, int, int]) -> Column:
    """The same formula as ``_pixels``, for images of real size."""

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        y, x, c = np.indices(shape)
        return images.in_pieces(batches, lambda k: ((31 * k + 7 * y + 13 * x + 17 * c) % 256).astype(np.uint8).tobytes())

    return run(seed)


def _image_steps(spark, sf_dir, shape: tuple[int, int, int]) -> DataFrame:
    """Every step of the conversations with an image."""
    steps = conversation_steps(spark, sf_dir)
    return steps.withColumn("image", _frames(F.col("conv_id") + F.col("step_index"), shape))


def lanczos_resize_steps(spark, sf_dir):
    steps = _image_steps(spark, sf_dir, SOURCE)
    out = steps.select("conv_id", "step_index", images.resize(F.col("image"), SOURCE, TARGET[:2]).alias("bytes"))
    return out.select("conv_id", "step_index", F.length("bytes").cast("long").alias("n_bytes"), F.lower(F.hex("bytes")).alias("h")).select("conv_id", "step_index", "n_bytes", F.sha2("h", 256).alias("sha256"))


def png_roundtrip_steps(spark, sf_dir):
    """Pixels are compared by their digest, so that only one form of an image is held."""
    steps = _image_steps(spark, sf_dir, TARGET).select("conv_id", "step_index", "image", F.sha2("image", 256).alias("digest"))
    stored = images.encode_columns(steps, {"image": TARGET})
    back = stored.select("conv_id", "step_index", "digest", images.decode_png(F.col("image")).alias("image"))
    return back.select("conv_id", "step_index", (F.sha2("image", 256) == F.col("digest")).alias("same"), F.length("image").cast("long").alias("n_bytes"))


def image_strip_steps(spark, sf_dir):
    steps = profile.strided(_image_steps(spark, sf_dir, SOURCE), 4)
    frames = steps.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("step_index", "image"))).alias("frames"))
    strip = F.lower(F.hex(images.strip(F.col("frames.image"), SOURCE)))
    return frames.select("conv_id", F.size("frames").cast("long").alias("n_frames"), F.sha2(strip, 256).alias("sha256"))


def synthetic_source(spark, sf_dir):
    s = synthetic.episodes(spark, {"train": 20, "val": 5}, images=None)
    ok = F.forall("action", lambda x: (x >= 0) & (x < 1)) & (F.size("action") == 10) & (F.size("state") == 10)
    return s.groupBy("split").agg(F.count_distinct("episode_id").alias("n_episodes"), F.count("*").alias("n_steps"), F.bool_and(ok).alias("in_range"))


# --- sources and sinks: what the tables hold is written, and read back


def _action(turn: str, text: str) -> Column:
    return F.array(F.col(turn).cast("float"), F.length(text).cast("float"), (F.col(turn) / 4).cast("float"))


def recordings_scan(spark, sf_dir):
    """A recording for each conversation, and its steps as the format reads them."""
    path = new_folder(spark, "recordings")
    steps = conversation_steps(spark, sf_dir).withColumn("episode_id", F.concat(F.lit("conv-"), "conv_id"))
    npy.write(steps.withColumn("action", _action("step_index", "language_instruction")), path)
    read = npy.scan(spark, path, ["episode_id", "step_index", "action", "language_instruction", "n_steps", "is_first", "is_last", "reward"])
    conv = F.regexp_extract("episode_id", r"conv-(\d+)\.npy$", 1).cast("long")
    return read.select(conv.alias("conv_id"), "step_index", *vectors.unnested(F.col("action"), ["a0", "a1", "a2"]), "language_instruction", "n_steps", "is_first", "is_last", "reward")


#: A small stored form of the conversations.
FRAME = (8, 8, 3)
STORED = EpisodeSchema(
    steps=(
        Feature("image", "uint8", "A frame by formula.", FRAME, "png"),
        Feature("action", "float32", "Turn, length of its text, a quarter of the turn.", (3,)),
        Feature("reward", "float", "1 on the last step."),
        Feature("is_last", "bool", "Last step."),
        Feature("language_instruction", "text", "The turn's text."),
    )
)


def _stored_steps(spark, sf_dir) -> DataFrame:
    steps = flagged_conversations(spark, sf_dir).withColumns({"split": split_of("conv_id"), "episode_id": F.col("conv_id").cast("string"), "action": _action("step_index", "language_instruction")})
    return steps.withColumn("image", _frames(F.col("conv_id") + F.col("step_index"), FRAME))


def dataset_write_read(spark, sf_dir):
    """One split of a stored dataset, its images decoded."""
    path = new_folder(spark, "dataset")
    dataset.write(_stored_steps(spark, sf_dir), path, STORED)
    back = dataset.read(spark, path, "val")
    return back.select(F.col("episode_id").cast("long").alias("conv_id"), "step_index", F.sha2(F.lower(F.hex("image")), 256).alias("sha256"), *vectors.unnested(F.col("action"), ["a0", "a1", "a2"]), "reward", "is_last", "language_instruction")


def dataset_overwrite(spark, sf_dir):
    """Steps and summaries of two versions: all steps, then every second one."""
    path = new_folder(spark, "dataset")
    steps = _stored_steps(spark, sf_dir)
    dataset.write(steps, path, STORED)
    dataset.write(steps.where("step_index % 2 = 0"), path, STORED, overwrite=True)
    out = None
    for n in (1, 2):
        read = dataset.read(spark, path, number=n).groupBy("split").agg(F.count("*").alias("n_read"), F.sum(F.element_at("action", 2)).cast("double").alias("total"))
        part = dataset.summary(spark, path, n).join(read, "split").select(F.lit(n).cast("long").alias("version"), "split", "n_episodes", "n_steps", "n_read", "total")
        out = part if out is None else out.unionByName(part)
    return out


def tfrecord_roundtrip(spark, sf_dir):
    path = new_folder(spark, "records")
    steps = conversation_steps(spark, sf_dir).select("conv_id", "step_index", "role", "language_instruction", _action("step_index", "language_instruction").alias("action"), (F.col("step_index") == 0).alias("is_first"))
    tfrecord.write(steps, path)
    back = tfrecord.read(spark, path, "conv_id long, step_index long, role string, language_instruction string, action array<float>, is_first boolean")
    return back.select("conv_id", "step_index", "role", "language_instruction", *vectors.unnested(F.col("action"), ["a0", "a1", "a2"]), "is_first")


# --- counts in the pass that writes, orders of epochs, views, stored vectors


def skip_write_counts(spark, sf_dir):
    """Kept rows are written; what was kept and skipped is counted meanwhile."""
    kept, seen = episodes.skip_in_pass(table(spark, sf_dir, "events").select("event_id", "user_id", "value"), F.col("value") >= 10)
    path = new_folder(spark, "kept")
    kept.write.parquet(path)
    counts = seen.get
    return spark.read.parquet(path).agg(F.count("*").alias("written"), F.sum("event_id").alias("ids")).select("written", "ids", F.lit(counts["kept"]).alias("kept"), F.lit(counts["skipped"]).alias("skipped"))


def verdict_in_pass(spark, sf_dir):
    """Target actions are written, and checked as they pass."""
    steps, seen = specs.observed(target_steps(spark, sf_dir), ACTION_SPEC)
    path = new_folder(spark, "target")
    steps.write.parquet(path)
    counts = seen.get
    return spark.read.parquet(path).groupBy().agg(F.count("*").alias("n_written")).select("n_written", F.lit(counts["n_rows"]).alias("n_rows"), F.lit(counts["n_bad_rows"]).alias("n_bad_rows"))


def violation_rows(spark, sf_dir):
    """Every value out of range, with what was expected."""
    bad = specs.violations(target_steps(spark, sf_dir), ACTION_SPEC, ["l_orderkey", "step_index"])
    return bad.select("l_orderkey", "step_index", "field", "check", "expected", F.col("actual").cast("float").alias("actual"))


def first_violation(spark, sf_dir):
    """Where a check that stops at the first violation stops."""
    first = specs.first_violation(target_steps(spark, sf_dir), ACTION_SPEC, ["l_orderkey", "step_index"])
    return first.select("l_orderkey", "step_index", "field", "check", "expected", F.col("actual").cast("float").alias("actual"))


def epoch_order(spark, sf_dir):
    return sample.epoch_order(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], seed=7, epoch=2)


def _full_steps(spark, sf_dir, shape) -> DataFrame:
    """Conversations with every feature of the source format."""
    steps = flagged_conversations(spark, sf_dir).withColumns({"split": split_of("conv_id"), "episode_id": F.col("conv_id").cast("string")})
    steps = steps.withColumns({"image": _frames(F.col("conv_id") + F.col("step_index"), shape), "state": F.array(F.col("step_index").cast("float"))})
    steps = steps.withColumn("action", F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: ((F.col("step_index") + i) / 8).cast("float")))
    return steps.withColumn("language_embedding", embed.HashEmbedder(512).column(F.col("language_instruction")))


_PICKED = (0, 1, 511)


def target_full_step(spark, sf_dir):
    """All nine fields of the target, the image at its real size."""
    out = Target().apply(_full_steps(spark, sf_dir, SOURCE), ["conv_id", "step_index"])
    image = F.col("observation.image")
    scalars = [c for c in COPIED if c != "language_embedding"]
    return out.select("conv_id", "step_index", F.sha2(F.lower(F.hex(image)), 256).alias("sha256"), *vectors.unnested(F.col("action"), [f"a{i}" for i in range(8)]), *scalars, F.size("language_embedding").cast("long").alias("n_embedding"), *[F.get("language_embedding", i).alias(f"e{i}") for i in _PICKED])


def target_report(spark, sf_dir):
    """Every check of the target format over all nine fields."""
    return specs.report(Target().apply(_full_steps(spark, sf_dir, SOURCE), ["conv_id", "step_index"]), specs.TARGET)


#: The source format but for its sizes; the wrist image is optional and not there.
NESTED = EpisodeSchema(steps=tuple(replace(f, shape=FRAME) if f.kind == "uint8" else f for f in STEP_FEATURES))


def nested_view_roundtrip(spark, sf_dir):
    """Flat steps to the nested view, by the schema, and back."""
    steps = _full_steps(spark, sf_dir, FRAME)
    paths = steps.select(*nesting.KEYS).distinct().withColumn("file_path", F.concat(F.lit("/raw/"), "episode_id"))
    nested = nesting.nested_view(steps, NESTED, paths)
    back = nesting.flat_view(nested, NESTED).join(nesting.episode_view(nested, NESTED), nesting.KEYS)
    scalars = ["discount", "reward", "is_first", "is_last", "is_terminal", "language_instruction"]
    return back.select(F.col("episode_id").cast("long").alias("conv_id"), "split", "step_index", "file_path", "n_steps", F.sha2(F.lower(F.hex("image")), 256).alias("sha256"), F.col("wrist_image").isNull().alias("no_wrist"), F.get("state", 0).alias("s0"), F.get("action", 9).alias("a9"), *scalars, F.get("language_embedding", 511).alias("e511"))


def mapped_steps(spark, sf_dir):
    """A function of one step, which drops some: words of long turns, in order of the alphabet."""

    def one(step: dict) -> dict | None:
        words = sorted(set(step["text"].split(" ")))
        return {"conv_id": step["conv_id"], "turn": step["turn"], "n_words": len(words), "first": words[0]} if len(step["text"]) >= 100 else None

    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text").where("text IS NOT NULL")
    schema = StructType.fromDDL("conv_id long, turn long, n_words long, first string")
    return map_steps(t, one, schema)


def changed_features(spark, sf_dir):
    """The nested view of a schema with one feature more and two fewer, flat again."""
    schema = NESTED.without_feature("state").without_feature("wrist_image").with_feature(Feature("role", "text", "Who speaks."))
    back = nesting.flat_view(nesting.nested_view(_full_steps(spark, sf_dir, FRAME), schema), schema)
    found = F.array_join(F.array(*[F.lit(c) for c in back.columns]), ",")
    return back.select(F.col("episode_id").cast("long").alias("conv_id"), "step_index", "role", "language_instruction", F.get("action", 0).alias("a0"), found.alias("features"))


def dtype_violations(spark, sf_dir):
    """Types of a stored table against a spec, before a row is read, and the rows that it is about."""
    docs = table(spark, sf_dir, "documents")
    spec = {"text": specs.Leaf("str"), "n_chars": specs.Leaf("float32", (), 0, 1), "lang": specs.Leaf("bool"), "audio": specs.Leaf("float32", (8,))}
    return specs.schema_report(docs, spec).withColumn("n_rows", F.lit(docs.count()))


def embedding_store(spark, sf_dir):
    """Two builds over one store: the second embeds what the first has not."""
    store = embed.EmbeddingStore(spark, new_folder(spark, "vectors"), embed.HashEmbedder(8), "hash")
    texts = table(spark, sf_dir, "conversations").select(F.col("turn"), F.substring("text", 1, 40).alias("start"))
    first = store.add(texts.where("turn % 2 = 0"), "start")
    second = store.add(texts, "start")
    out = store.embed(texts, "start", "vector")
    return out.groupBy("start").agg(F.count("*").alias("n"), F.min(F.get("vector", 3)).alias("e3")).withColumns({"first": F.lit(first).cast("long"), "second": F.lit(second).cast("long")})


def lexical_embedding(spark, sf_dir):
    """An encoder trained on all turns, and each turn's vector."""
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    model = lexical.train(t, "text", 64)
    out = t.withColumn("v", model.column(F.col("text")))
    return out.select("conv_id", "turn", F.size("v").cast("long").alias("size"), *[F.round(F.get("v", i).cast("double"), 4).alias(f"v{i}") for i in range(4)], F.round(lexical.similarity(F.col("v"), F.col("v")), 3).alias("norm"))


def synthetic_episodes(spark, sf_dir):
    """An episode of made-up measures for each customer."""
    rows = table(spark, sf_dir, "customer").select("c_custkey")
    out = synthetic.for_rows(rows, "c_custkey", F.col("c_custkey") % 4, {"state": 2, "action": 3}, 5, (2, 1, 3))
    return out.select("c_custkey", "step_index", *vectors.unnested(F.col("state"), ["s0", "s1"]), *vectors.unnested(F.col("action"), ["a0", "a1", "a2"]), F.lower(F.hex("image")).alias("image"))


ALL = (
    step_index, episode_length, first_last_terminal, terminal_reward, temporal_stride, last_instruction_caption, last_step, nest_unnest_roundtrip, nested_flags, episode_metadata, zero_step_episodes,
    empty_episodes_nested, duplicate_keys, skip_examples, skipped_count, split_assign, dataset_summary, event_index, slice_head, slice_mid, slice_tail, slice_stride, target_action, copy_fields, check_shape, check_range_uniform,
    check_range_per_dim, violations_report, pass_verdict, ragged_vectors, vector_mean, embedding_mean, vector_histogram, vector_nonfinite, sample_episodes, sampled_steps, hash_embed_distinct, image_strip, lanczos_resize, png_roundtrip,
    image_strip_steps, lanczos_resize_steps, png_roundtrip_steps, synthetic_source, long_episode_flags, long_last_step, recordings_scan, dataset_write_read, dataset_overwrite, tfrecord_roundtrip,
    skip_write_counts, verdict_in_pass, violation_rows, first_violation, epoch_order, target_full_step, target_report, nested_view_roundtrip, embedding_store, synthetic_episodes,
    mapped_steps, changed_features, dtype_violations, lexical_embedding,
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in ALL}


# --- the same in SQL

_INDEXED = f"SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE_ORDER)}) - 1 AS step_index FROM lineitem"
_ACTION = "[" + ", ".join(f"cast({m} as float)" for m in MEASURES) + "]"
_STATE = "[" + ", ".join(f"{c} + 0e0" for c in STATE) + "]"
_ORDER_STEPS = f"(SELECT *, {_ACTION} AS action, {_STATE} AS state FROM ({_INDEXED}))"
_TARGET = "(SELECT l_orderkey, step_index, [" + ", ".join(f"action[{i + 1}]" for i in TAKEN) + f"] AS action FROM {_ORDER_STEPS})"
_FLAGS = "SELECT conv_id, turn AS step_index, text, turn = 0 AS is_first, turn = count(*) OVER (PARTITION BY conv_id) - 1 AS is_last FROM conversations"
_SPLIT = "CASE WHEN conv_id % 10 = 0 THEN 'val' ELSE 'train' END"
_BOUNDS = [(float(a), float(b)) for a, b in zip(specs.TARGET["action"].low, specs.TARGET["action"].high, strict=True)]
_BAD = [f"NOT (action[{i + 1}]::DOUBLE >= {a!r}::DOUBLE AND action[{i + 1}]::DOUBLE <= {b!r}::DOUBLE)" for i, (a, b) in enumerate(_BOUNDS)]
_LONG = f"""(SELECT 'action' AS kind, unnest(range(0, 10)) AS dim, unnest(action)::DOUBLE AS value FROM {_ORDER_STEPS}
  UNION ALL SELECT 'state', unnest(range(0, 4)), unnest(state)::DOUBLE FROM {_ORDER_STEPS})"""


def _pick(expression: str, places: list[int], prefix: str) -> str:
    return ", ".join(f"{expression}[{p}] AS {prefix}{i}" for i, p in enumerate(places))


def _resize_sql() -> str:
    w = images.weights(16, 32)
    rows = ", ".join(f"({o}, {i}, {int(w[o, i])}::BIGINT)" for o in range(32) for i in range(16) if w[o, i])
    half, full = 1 << (images.BITS - 1), 1 << images.BITS
    byte = f"least(255, greatest(0, floor((sum(w * v) + {half})::DOUBLE / {full})))::BIGINT"
    return f"""
WITH weight(o, i, w) AS (VALUES {rows}),
px AS (SELECT r_regionkey::BIGINT AS img, y, x, c, (31 * r_regionkey + 7 * y + 13 * x + 17 * c) % 256 AS v
       FROM region, range(16) a(y), range(16) b(x), range(3) d(c)),
wide AS (SELECT img, y, o AS x, c, {byte} AS v FROM px JOIN weight ON i = px.x GROUP BY img, y, o, c)
SELECT img, o::BIGINT AS y, x::BIGINT AS x, c::BIGINT AS c, {byte} AS v FROM wide JOIN weight ON i = wide.y GROUP BY img, o, x, c"""


def _resized_digests() -> str:
    """The CTEs up to ``done``: img, n_bytes and digest of each image of conversations."""
    w = images.weights(SOURCE[0], TARGET[0])
    rows = ", ".join(f"({o}, {i}, {int(w[o, i])}::BIGINT)" for o in range(TARGET[0]) for i in range(SOURCE[0]) if w[o, i])
    half, full = 1 << (images.BITS - 1), 1 << images.BITS
    byte = f"least(255, greatest(0, floor((sum(w * v) + {half})::DOUBLE / {full})))::BIGINT"
    return f"""
weight(o, i, w) AS (VALUES {rows}),
seeds AS (SELECT DISTINCT (conv_id + turn) % 256 AS img FROM conversations),
px AS (SELECT img, y, x, c, (31 * img + 7 * y + 13 * x + 17 * c) % 256 AS v FROM seeds, range({SOURCE[0]}) a(y), range({SOURCE[1]}) b(x), range(3) d(c)),
wide AS (SELECT img, y, o AS x, c, {byte} AS v FROM px JOIN weight ON i = px.x GROUP BY img, y, o, c),
tall AS (SELECT img, o AS y, x, c, {byte} AS v FROM wide JOIN weight ON i = wide.y GROUP BY img, o, x, c),
done AS (SELECT img, count(*)::BIGINT AS n_bytes, sha256(string_agg(lpad(lower(hex(v)), 2, '0'), '' ORDER BY y, x, c)) AS sha256 FROM tall GROUP BY img)"""


def _resize_steps_sql() -> str:
    return f"""
WITH {_resized_digests()}
SELECT conv_id, turn AS step_index, n_bytes, sha256 FROM conversations JOIN done ON img = (conv_id + turn) % 256"""


def _uniform_sql(label: str, j: int) -> str:
    return f"(('0x' || substr(md5('5|{label}|' || c_custkey || '|' || i || '|{j}'), 1, 6))::BIGINT / 16777216e0)::FLOAT"


def _hash_sql(text: str, j: int) -> str:
    return f"(('0x' || substr(md5({text} || '#{j}'), 1, 4))::BIGINT / 32767.5e0 - 1)::FLOAT"


def _target_report_sql() -> str:
    """Counts of bad rows: shapes hold by construction, values follow from the turn."""
    action = specs.TARGET["action"]
    good = {"observation.image": "true", "language_embedding": "text IS NOT NULL"}
    parts = [(path, "shape", good.get(path, "true")) for path, leaf in specs.leaves(specs.TARGET) if leaf.shape]
    parts += [(f"action[{k}]", "range", f"((turn + {d}) / 8)::FLOAT::DOUBLE BETWEEN {float(a)!r}::DOUBLE AND {float(b)!r}::DOUBLE") for k, (d, a, b) in enumerate(zip(TAKEN, action.low, action.high, strict=True))]
    parts += [(c, "range", "true") for c in ("discount", "reward")]
    return " UNION ALL ".join(f"SELECT '{f}' AS field, '{c}' AS \"check\", count(*) FILTER (WHERE NOT coalesce({g}, false)) AS n_bad, count(*) FILTER (WHERE {g}) AS n_good FROM conversations" for f, c, g in parts)


_DIGIT = "(strpos('0123456789abcdef', substr(h, {0}, 1)) - 1)"
_CODE = f"({_DIGIT.format(1)} * 4096 + {_DIGIT.format(2)} * 256 + {_DIGIT.format(3)} * 16 + {_DIGIT.format(4)})"
_SAMPLE = "SELECT conv_id FROM (SELECT DISTINCT conv_id FROM conversations) ORDER BY md5('{0}|' || conv_id), conv_id LIMIT {1}"
_PX = "lpad(lower(hex((31 * (conv_id + turn) + 7 * y + 13 * x + 17 * c) % 256)), 2, '0')"

_LONG_EPISODE = "(SELECT *, row_number() OVER w - 1 AS step_index, count(*) OVER (PARTITION BY u) AS n FROM (SELECT CASE WHEN event_id % 2 = 0 THEN -1 ELSE user_id END AS u, * FROM events) WINDOW w AS (PARTITION BY u ORDER BY ts, event_id))"
_ACTIONS = "turn::FLOAT AS a0, length(text)::FLOAT AS a1, (turn / 4)::FLOAT AS a2"
_FRAME_PX = f"SELECT img, sha256(string_agg(lpad(lower(hex((31 * img + 7 * y + 13 * x + 17 * c) % 256)), 2, '0'), '' ORDER BY y, x, c)) AS sha256 FROM (SELECT DISTINCT conv_id + turn AS img FROM conversations), range({FRAME[0]}) a(y), range({FRAME[1]}) b(x), range(3) d(c) GROUP BY img"

_FULL = "turn AS step_index, 1::FLOAT AS discount, is_last::INT::FLOAT AS reward, turn = 0 AS is_first, is_last, is_last AS is_terminal, text AS language_instruction"
_ENDS = "(SELECT *, turn = max(turn) OVER (PARTITION BY conv_id) AS is_last, count(*) OVER (PARTITION BY conv_id) AS n_steps FROM conversations)"
_EXPECTED = [f"[{a}, {b}]" for a, b in zip(specs.TARGET["action"].low, specs.TARGET["action"].high, strict=True)]
_VIOLATIONS = " UNION ALL ".join(f"SELECT l_orderkey, step_index, {i} AS place, 'action[{i}]' AS field, 'range' AS \"check\", '{_EXPECTED[i]}' AS expected, action[{i + 1}] AS actual FROM {_TARGET} WHERE {b}" for i, b in enumerate(_BAD))
_ROUND = f"lambda x, r: CASE WHEN substr(md5('7|2|' || r || '|' || greatest(x, (('0x' || substr(md5('7|2|' || r || '|'), 1, 12))::BIGINT % n + n - x) % n)), 1, 1) >= '8' THEN (('0x' || substr(md5('7|2|' || r || '|'), 1, 12))::BIGINT % n + n - x) % n ELSE x END"

ORACLE_SQL: dict[str, str] = {
    "lexical_embedding": r"""
WITH w AS (SELECT conv_id, turn, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM conversations),
h AS (SELECT conv_id, turn, md5(word) AS h, count(*) AS n FROM w GROUP BY ALL),
c AS (SELECT conv_id, turn, ('0x' || substr(h, 1, 8))::BIGINT % 64 AS d, CASE WHEN substr(h, 9, 1) >= '8' THEN n ELSE -n END AS n, substr(h, 10, 4) AS b FROM h),
df AS (SELECT b, ln((1 + (SELECT count(*) FROM conversations WHERE text IS NOT NULL)) / (1 + count(DISTINCT (conv_id, turn)))::DOUBLE) + 1 AS idf FROM c GROUP BY b),
dims AS (SELECT conv_id, turn, d, sum(n * idf) AS x FROM c JOIN df USING (b) GROUP BY ALL),
len AS (SELECT conv_id, turn, sqrt(sum(x * x)) AS l FROM dims GROUP BY ALL)
SELECT t.conv_id, t.turn, 64::BIGINT AS size, """
    + ", ".join(f"round(coalesce((SELECT x / l FROM dims d WHERE d.conv_id = t.conv_id AND d.turn = t.turn AND d.d = {i}), 0)::FLOAT::DOUBLE, 4) AS v{i}" for i in range(4))
    + ", CASE WHEN l > 0 THEN 1e0 ELSE 0e0 END AS norm FROM conversations t LEFT JOIN len USING (conv_id, turn)",
    "mapped_steps": "SELECT conv_id, turn, len(w)::BIGINT AS n_words, list_min(w) AS first FROM (SELECT conv_id, turn, list_distinct(string_split(text, ' ')) AS w FROM conversations WHERE length(text) >= 100)",
    "changed_features": "SELECT conv_id, turn AS step_index, role, text AS language_instruction, (turn / 8)::FLOAT AS a0, 'split,episode_id,step_index,image,action,discount,reward,is_first,is_last,is_terminal,language_instruction,language_embedding,role' AS features FROM conversations",
    "dtype_violations": """
WITH t AS (SELECT any_value(typeof(n_chars)) AS n_chars, any_value(typeof(lang)) AS lang, count(*) AS n_rows FROM documents),
named AS (SELECT CASE n_chars WHEN 'BIGINT' THEN 'bigint' ELSE lower(n_chars) END AS n_chars, CASE lang WHEN 'VARCHAR' THEN 'string' ELSE lower(lang) END AS lang, n_rows FROM t)
SELECT 'n_chars' AS field, 'dtype' AS "check", 'float32' AS expected, n_chars AS actual, n_rows FROM named WHERE n_chars <> 'float'
UNION ALL SELECT 'lang', 'dtype', 'bool', lang, n_rows FROM named WHERE lang <> 'boolean'
UNION ALL SELECT 'audio', 'missing', 'float32', 'absent', n_rows FROM named""",
    "skip_write_counts": "SELECT count(*) FILTER (WHERE value >= 10) AS written, sum(event_id) FILTER (WHERE value >= 10)::BIGINT AS ids, count(*) FILTER (WHERE value >= 10) AS kept, count(*) FILTER (WHERE NOT coalesce(value >= 10, false)) AS skipped FROM events",
    "verdict_in_pass": f"SELECT count(*) AS n_written, count(*) AS n_rows, count(*) FILTER (WHERE {' OR '.join(_BAD)}) AS n_bad_rows FROM {_TARGET}",
    "violation_rows": f"SELECT l_orderkey, step_index, field, \"check\", expected, actual FROM ({_VIOLATIONS})",
    "first_violation": f"SELECT l_orderkey, step_index, field, \"check\", expected, actual FROM ({_VIOLATIONS}) ORDER BY l_orderkey, step_index, place LIMIT 1",
    "epoch_order": f"WITH o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, count(*) OVER () AS n FROM orders) SELECT o_orderkey, list_reduce(range(0, {sample.ROUNDS}), {_ROUND}, i) AS place FROM o",
    "target_full_step": f"WITH {_resized_digests()} SELECT conv_id, sha256, {', '.join(f'((turn + {d}) / 8)::FLOAT AS a{k}' for k, d in enumerate(TAKEN))}, {_FULL}, 512::BIGINT AS n_embedding, {', '.join(f'{_hash_sql("text", j)} AS e{j}' for j in _PICKED)} FROM {_ENDS} JOIN done ON img = (conv_id + turn) % 256",
    "target_report": _target_report_sql(),
    "nested_view_roundtrip": f"WITH px AS ({_FRAME_PX}) SELECT conv_id, {_SPLIT} AS split, '/raw/' || conv_id AS file_path, n_steps, sha256, true AS no_wrist, turn::FLOAT AS s0, ((turn + 9) / 8)::FLOAT AS a9, {_FULL}, {_hash_sql('text', 511)} AS e511 FROM {_ENDS} JOIN px ON img = conv_id + turn",
    "embedding_store": f"WITH t AS (SELECT turn, substr(text, 1, 40) AS start FROM conversations), n AS (SELECT count(DISTINCT start) FILTER (WHERE turn % 2 = 0) AS one, count(DISTINCT start) AS whole FROM t) SELECT start, count(*) AS n, {_hash_sql('start', 3)} AS e3, any_value(one) AS first, any_value(whole - one) AS second FROM t, n GROUP BY start",
    "synthetic_episodes": f"SELECT c_custkey, i AS step_index, {', '.join(f'{_uniform_sql("state", j)} AS s{j}' for j in range(2))}, {', '.join(f'{_uniform_sql("action", j)} AS a{j}' for j in range(3))}, {' || '.join(f"lpad(lower(hex(floor({_uniform_sql('image', j)}::DOUBLE * 255)::BIGINT)), 2, '0')" for j in range(6))} AS image FROM (SELECT c_custkey, unnest(range(0, c_custkey % 4)) AS i FROM customer)",
    "long_episode_flags": f"SELECT u::BIGINT AS user_id, event_id, step_index, step_index = 0 AS is_first, step_index = n - 1 AS is_last, step_index = n - 1 AS is_terminal, (step_index = n - 1)::INT::FLOAT AS reward, 1::FLOAT AS discount FROM {_LONG_EPISODE}",
    "long_last_step": f"SELECT u::BIGINT AS user_id, event_id, step_index, event_type FROM {_LONG_EPISODE} WHERE step_index = n - 1",
    "recordings_scan": f"SELECT conv_id, turn AS step_index, {_ACTIONS}, text AS language_instruction, count(*) OVER (PARTITION BY conv_id) AS n_steps, turn = 0 AS is_first, turn = max(turn) OVER (PARTITION BY conv_id) AS is_last, (turn = max(turn) OVER (PARTITION BY conv_id))::INT::FLOAT AS reward FROM conversations",
    "dataset_write_read": f"WITH px AS ({_FRAME_PX}) SELECT conv_id, turn AS step_index, sha256, {_ACTIONS}, (turn = max(turn) OVER (PARTITION BY conv_id))::INT::FLOAT AS reward, turn = max(turn) OVER (PARTITION BY conv_id) AS is_last, text AS language_instruction FROM conversations JOIN px ON img = conv_id + turn WHERE conv_id % 10 = 0",
    "dataset_overwrite": f"SELECT v::BIGINT AS version, {_SPLIT} AS split, count(DISTINCT conv_id) AS n_episodes, count(*) AS n_steps, count(*) AS n_read, sum(length(text))::DOUBLE AS total FROM conversations, range(1, 3) r(v) WHERE turn % v = 0 GROUP BY ALL",
    "tfrecord_roundtrip": f"SELECT conv_id, turn AS step_index, role, text AS language_instruction, {_ACTIONS}, turn = 0 AS is_first FROM conversations",
    "step_index": f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, step_index FROM ({_INDEXED})",
    "episode_length": "SELECT l_orderkey, count(*) AS n_steps FROM lineitem GROUP BY l_orderkey",
    "first_last_terminal": f"SELECT conv_id, step_index, is_first, is_last, is_last AS is_terminal FROM ({_FLAGS})",
    "terminal_reward": f"SELECT conv_id, step_index, is_last::INT::FLOAT AS reward, 1::FLOAT AS discount FROM ({_FLAGS})",
    "temporal_stride": "SELECT conv_id, turn AS step_index, role, text AS language_instruction FROM conversations WHERE turn % 4 = 0",
    "last_instruction_caption": "SELECT conv_id, arg_max(text, turn) || ' (temp. downsampled 4x)' AS caption FROM conversations GROUP BY conv_id",
    "last_step": "SELECT conv_id, turn AS step_index, role, text AS language_instruction FROM conversations QUALIFY turn = max(turn) OVER (PARTITION BY conv_id)",
    "nest_unnest_roundtrip": f"SELECT l_orderkey, step_index, l_partkey, l_quantity FROM ({_INDEXED})",
    "nested_flags": f"SELECT conv_id, step_index, is_first, is_last, is_last AS is_terminal, is_last::INT::FLOAT AS reward, 1::FLOAT AS discount FROM ({_FLAGS})",
    "episode_metadata": "SELECT l_orderkey, l_linenumber, l_partkey, o_orderpriority AS priority, o_orderdate AS order_date FROM lineitem JOIN orders ON o_orderkey = l_orderkey",
    "zero_step_episodes": "SELECT o_orderkey AS l_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
    "empty_episodes_nested": "SELECT o_orderkey AS l_orderkey, count(l_orderkey) AS n_steps FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey",
    "duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "skip_examples": "SELECT event_id, user_id, event_type, value FROM events WHERE value >= 10",
    "skipped_count": "SELECT count(*) FILTER (WHERE NOT coalesce(value >= 10, false)) AS skipped FROM events",
    "split_assign": f"SELECT {_SPLIT} AS split, count(DISTINCT conv_id) AS n_episodes, count(*) AS n_steps FROM conversations GROUP BY 1",
    "dataset_summary": f"SELECT {_SPLIT} AS split, count(DISTINCT conv_id) AS n_episodes, count(*) AS n_steps, sum(strlen(text))::BIGINT AS n_bytes FROM conversations GROUP BY 1",
    "event_index": "SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS step_index FROM events",
    "slice_head": f"SELECT vec_id, {_pick('embedding', [1, 2, 3], 'e')} FROM embeddings",
    "slice_mid": f"SELECT vec_id, {_pick('embedding', [6, 7, 8], 'e')} FROM embeddings",
    "slice_tail": f"SELECT vec_id, {_pick('embedding', [-2, -1], 'e')} FROM embeddings",
    "slice_stride": f"SELECT vec_id, {_pick('embedding', list(range(1, 65, 4)), 'e')} FROM embeddings",
    "target_action": f"SELECT l_orderkey, step_index, {_pick('action', list(range(1, 9)), 'a')} FROM {_TARGET}",
    "copy_fields": f"SELECT conv_id, step_index, 1::FLOAT AS discount, is_last::INT::FLOAT AS reward, is_first, is_last, is_last AS is_terminal, text AS language_instruction, length(text)::FLOAT AS language_embedding FROM ({_FLAGS})",
    "check_shape": "SELECT vec_id, coalesce(len(embedding) = 64, false) AS ok FROM embeddings",
    "check_range_uniform": "SELECT vec_id, list_min(embedding)::DOUBLE >= (-0.4)::DOUBLE AND list_max(embedding)::DOUBLE <= 0.4::DOUBLE AS ok FROM embeddings",
    "check_range_per_dim": " UNION ALL ".join(f"SELECT l_orderkey, step_index, {i}::BIGINT AS dim FROM {_TARGET} WHERE {b}" for i, b in enumerate(_BAD)),
    "violations_report": f"SELECT 'action' AS field, 'shape' AS \"check\", count(*) FILTER (WHERE len(action) <> 8) AS n_bad, count(*) FILTER (WHERE len(action) = 8) AS n_good FROM {_TARGET} UNION ALL "
    + " UNION ALL ".join(f"SELECT 'action[{i}]', 'range', count(*) FILTER (WHERE {b}), count(*) FILTER (WHERE NOT ({b})) FROM {_TARGET}" for i, b in enumerate(_BAD)),
    "pass_verdict": f"SELECT count(*) FILTER (WHERE {' OR '.join(_BAD)}) = 0 AS passed, count(*) AS n_rows, count(*) FILTER (WHERE {' OR '.join(_BAD)}) AS n_bad_rows FROM {_TARGET}",
    "ragged_vectors": "SELECT 'words' AS kind, min(n)::BIGINT AS smallest, max(n)::BIGINT AS largest FROM (SELECT len(string_split(text, ' ')) AS n FROM conversations) HAVING min(n) <> max(n)",
    "vector_mean": f"SELECT kind, dim, round(avg(value), 6) AS mean, count(*) AS n FROM {_LONG} GROUP BY kind, dim",
    "embedding_mean": "SELECT dim, round(avg(value), 6) AS mean, count(*) AS n FROM (SELECT unnest(range(0, 64)) AS dim, unnest(embedding)::DOUBLE AS value FROM embeddings) GROUP BY dim",
    "vector_histogram": f"""
WITH v AS {_LONG}, e AS (SELECT kind, dim, CASE WHEN min(value) = max(value) THEN min(value) - 0.5e0 ELSE min(value) END AS low,
                                CASE WHEN min(value) = max(value) THEN max(value) + 0.5e0 ELSE max(value) END AS high FROM v GROUP BY kind, dim)
SELECT kind, dim, ({" + ".join(f"(value >= {i}e0 * ((high - low) / 20e0) + low)::BIGINT" for i in range(1, 20))})::BIGINT AS bin, count(*) AS n FROM v JOIN e USING (kind, dim) GROUP BY ALL""",
    "vector_nonfinite": "SELECT 'state' AS kind, unnest([0, 1])::BIGINT AS dim, unnest([count(*) FILTER (WHERE value IS NULL), count(*) FILTER (WHERE value IS NULL OR value > 400)]) AS n_nonfinite FROM events",
    "sample_episodes": _SAMPLE.format(42, 50),
    "sampled_steps": f"SELECT conv_id, turn AS step_index, role FROM conversations WHERE conv_id IN ({_SAMPLE.format(42, 50)})",
    "hash_embed_distinct": f"SELECT event_type, n, j AS dim, ({_CODE} / 32767.5e0 - 1)::FLOAT AS value FROM (SELECT event_type, n, j, md5(event_type || '#' || j) AS h FROM (SELECT event_type, count(*) AS n FROM events GROUP BY event_type), range(8) r(j))",
    "image_strip": f"""
WITH s AS (SELECT * FROM conversations WHERE conv_id IN ({_SAMPLE.format(1, 20)})),
px AS (SELECT conv_id, string_agg({_PX}, '' ORDER BY y, turn, x, c) AS strip_hex FROM s, range(2) a(y), range(2) b(x), range(3) d(c) WHERE turn % 4 = 0 GROUP BY conv_id)
SELECT conv_id, n_frames, strip_hex, caption FROM px JOIN (SELECT conv_id, count(*) FILTER (WHERE turn % 4 = 0) AS n_frames, arg_max(text, turn) || ' (temp. downsampled 4x)' AS caption FROM s GROUP BY conv_id) USING (conv_id)""",
    "lanczos_resize": _resize_sql(),
    "png_roundtrip": "SELECT n_nationkey::BIGINT AS img, true AS same, 768::BIGINT AS n_bytes FROM nation",
    "image_strip_steps": f"""
SELECT conv_id, count(DISTINCT turn)::BIGINT AS n_frames, sha256(string_agg({_PX}, '' ORDER BY y, turn, x, c)) AS sha256
FROM conversations, range({SOURCE[0]}) a(y), range({SOURCE[1]}) b(x), range(3) d(c) WHERE turn % 4 = 0 GROUP BY conv_id""",
    "lanczos_resize_steps": _resize_steps_sql(),
    "png_roundtrip_steps": "SELECT conv_id, turn AS step_index, true AS same, 49152::BIGINT AS n_bytes FROM conversations",
    "synthetic_source": "SELECT * FROM (VALUES ('train', 20::BIGINT, 200::BIGINT, true), ('val', 5::BIGINT, 50::BIGINT, true)) t(split, n_episodes, n_steps, in_range)",
}

assert math.isclose(_BOUNDS[3][1], 2 * math.pi) and len(ACTION_SLICES) == 3


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target actions of all order lines against the target's spec."""
    return violations_report(spark, sf_dir)

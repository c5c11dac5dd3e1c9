"""The library's operators: one test or more for each edge of their semantics."""

import math
import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillon import queries
from quillon.functions import embed, images, vectors
from quillon.operators import episodes, profile, sample
from quillon.plans import spec
from quillon.plans.schema import EpisodeSchema, Feature
from quillon.plans.transform import Target, map_steps
from quillon.sources import dataset, npy, synthetic
from quillon.streaming import ingest

TWO_PI = 2 * math.pi


def float32(x):
    return struct.unpack("f", struct.pack("f", x))[0]


# --- vectors


def test_slices_are_pythons(spark):
    rows = [list(range(n)) for n in (0, 1, 2, 3, 7, 8, 10, 12)]
    df = spark.createDataFrame([(r,) for r in rows], "a array<int>")
    bounds = [(None, 3), (5, 8), (-2, None), (0, 0), (3, 1), (-5, -1), (2, None), (None, -4), (-20, 20)]
    got = df.select("a", *[vectors.part(F.col("a"), *b).alias(f"s{i}") for i, b in enumerate(bounds)], vectors.every(F.col("a"), 4).alias("every"), vectors.last(F.col("a")).alias("last")).collect()
    for r in got:
        assert [r[f"s{i}"] for i in range(len(bounds))] == [r.a[b[0] : b[1]] for b in bounds]
        assert r.every == r.a[::4] and r["last"] == (r.a[-1] if r.a else None)


def test_target_action(spark):
    df = spark.createDataFrame([("e", i, [float(x) for x in range(n)]) for i, n in enumerate((10, 8, 1, 0))], "k string, step_index int, action array<float>")
    got = {r.step_index: r.action for r in Target(copied=()).apply(df, ["k", "step_index"]).collect()}
    assert got == {0: [0, 1, 2, 5, 6, 7, 8, 9], 1: [0, 1, 2, 5, 6, 7, 6, 7], 2: [0, 0], 3: []}
    assert Target().apply(df, ["k"]).schema["action"].dataType.simpleString() == "array<float>"


def test_map_steps(spark):
    df = spark.range(6).withColumn("x", F.col("id") * 2)
    out = map_steps(df, lambda s: None if s["id"] % 2 else {"id": s["id"], "y": s["x"] + 1}, spark.createDataFrame([], "id long, y long").schema)
    assert sorted(map(tuple, out.collect())) == [(0, 1), (2, 5), (4, 9)]


# --- episodes


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=5))
def test_flags(spark, lengths):
    rows = [(e, 10 - i) for e, n in enumerate(lengths) for i in range(n)]
    steps = episodes.derive_flags(episodes.index_steps(spark.createDataFrame(rows, "e int, t int"), ["e"], ["t"]), ["e"])
    for e, n in enumerate(lengths):
        mine = sorted((r for r in steps.collect() if r.e == e), key=lambda r: r.step_index)
        assert [r.step_index for r in mine] == list(range(n))
        assert [r.is_first for r in mine] == [i == 0 for i in range(n)]
        assert [(r.is_last, r.is_terminal, r.reward, r.discount) for r in mine] == [(i == n - 1, i == n - 1, float(i == n - 1), 1.0) for i in range(n)]


def test_no_demonstration(spark):
    got = episodes.derive_flags(spark.range(3).withColumns({"e": F.lit(1), "step_index": F.col("id")}), ["e"], demo=False).collect()
    assert sum(r.is_last for r in got) == 1 and not any(r.is_terminal or r.reward for r in got)


def test_one_exchange_for_positions(spark):
    df = episodes.derive_flags(episodes.index_steps(spark.range(9).withColumn("e", F.col("id") % 2), ["e"], ["id"]), ["e"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_nest_keeps_empty_episodes(spark):
    steps = spark.createDataFrame([(1, 1, "b"), (1, 0, "a")], "e int, step_index long, x string")
    nested = episodes.nest(steps, ["e"], spark.createDataFrame([(1, "p"), (2, "q")], "e int, file_path string"))
    got = {r.e: (r.file_path, [(s.step_index, s.x) for s in r.steps]) for r in nested.collect()}
    assert got == {1: ("p", [(0, "a"), (1, "b")]), 2: ("q", [])}
    assert sorted(map(tuple, episodes.unnest(nested, ["e"]).collect())) == [(1, 0, "a"), (1, 1, "b")]
    assert episodes.unnest(nested, ["e"], outer=True).where("e = 2").collect()[0].x is None


def test_keys_and_skips(spark):
    df = spark.createDataFrame([(1, 5.0), (1, None), (2, 20.0)], "k int, v double")
    assert [tuple(r) for r in episodes.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    with pytest.raises(ValueError, match="duplicate keys"):
        episodes.require_unique(df, ["k"])
    kept, skipped = episodes.skip(df, F.col("v") > 6)
    assert kept.count() == 1 and skipped.first().skipped == 2
    assert [tuple(r) for r in episodes.order_ties(df, [], ["k"]).collect()] == [(1, 2)]


# --- specs

ACTION = {"action": spec.TARGET["action"]}


def test_ranges(spark):
    ok = [0.0] * 8
    cases = {"ok": ok, "edge": [1, 1, 1, float32(6.28), -6.28, 0, -1, 1], "over": [1.0000001, *ok[1:]], "two pi": [0, 0, 0, float32(TWO_PI), 0, 0, 0, 0], "nan": [float("nan"), *ok[1:]], "inf": [0, float("-inf"), *ok[2:]], "null in": [None, *ok[1:]], "null": None, "short": ok[:7], "long": [*ok, 0.0], "last": [*ok[:7], -0.1]}
    df = spark.createDataFrame([(k, None if v is None else [None if x is None else float(x) for x in v]) for k, v in cases.items()], "k string, action array<float>")
    bad: dict = {}
    for r in spec.violations(df, ACTION, ["k"]).collect():
        bad.setdefault(r.k, set()).add(r.field + " " + r.check)
    assert "ok" not in bad and "edge" not in bad
    assert bad["over"] == {"action[0] range"} and bad["two pi"] == {"action[3] range"} and bad["nan"] == {"action[0] range"} and bad["inf"] == {"action[1] range"}
    assert bad["null in"] == {"action[0] range"} and "action shape" in bad["null"] and bad["short"] == {"action shape", "action[7] range"} and bad["long"] == {"action shape"} and bad["last"] == {"action[7] range"}
    v = spec.verdict(df, ACTION).first()
    assert (v.passed, v.n_rows, v.n_bad_rows) == (False, len(cases), len(bad))
    with pytest.raises(ValueError, match="action"):
        spec.require(df, ACTION, ["k"])
    assert spec.require(df.where("k = 'ok'"), ACTION, ["k"]).count() == 1


def test_schema_violations(spark):
    df = spark.createDataFrame([], "action array<double>, is_first int, audio binary, observation struct<image: binary>")
    found = {(f, c) for f, c, _, _ in spec.schema_violations(df.schema, spec.TARGET)}
    assert ("action", "dtype") in found and ("is_first", "dtype") in found and ("reward", "missing") in found
    assert not [f for f, _ in found if f in ("audio", "observation.image")]
    with pytest.raises(TypeError):
        spec.violations(df, spec.TARGET, [])


def test_full_target(spark):
    src = synthetic.episodes(spark, {"train": 2}, steps=3)
    src = episodes.derive_flags(src, dataset.KEYS)
    src = embed.embed_distinct(src, "language_instruction", embed.HashEmbedder(), "language_embedding")
    out = Target().apply(src, [*dataset.KEYS, "step_index"])
    assert spec.verdict(out, spec.TARGET, strict=True).first().passed
    assert "wrist_image" not in out.columns and out.first().observation.image.__len__() == 128 * 128 * 3
    only = out.select("action")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in only and "resize" not in only


# --- profiles


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=40))
def test_histogram_is_numpys(spark, values):
    df = spark.createDataFrame([([v],) for v in values], "v array<double>")
    got = {r.bin: r.n for r in profile.vector_histogram(df, ["v"]).collect()}
    plan = profile.vector_histogram(df, ["v"])._jdf.queryExecution().toString()
    assert "BuildRight" in plan and "BuildLeft" not in plan  # the ends go to the values
    low, high = min(values), max(values)
    if low == high:
        low, high = low - 0.5, high + 0.5
    edges = [i * ((high - low) / 20) + low for i in range(1, 20)]
    want: dict = {}
    for v in values:
        b = sum(v >= e for e in edges)
        want[b] = want.get(b, 0) + 1
    assert got == want


def test_histogram_grid_and_constant(spark):
    grid = [i / 100 for i in range(11)] * 3
    df = spark.createDataFrame([([v, 7.0],) for v in grid], "v array<double>")
    got: dict = {}
    for r in profile.vector_histogram(df, ["v", "absent"]).collect():
        got.setdefault(r.dim, {})[r.bin] = r.n
    want, _ = np.histogram(grid, 20)
    assert [got[0].get(i, 0) for i in range(20)] == want.tolist()
    assert got[1] == {10: len(grid)}
    assert profile.ragged(spark.createDataFrame([([1.0],), ([1.0, 2.0],)], "v array<double>"), ["v", "absent"]).count() == 1


def test_means_weigh_steps(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [6.0, 3.0])], "e int, state array<float>")
    got = {r.dim: r["mean"] for r in profile.vector_mean(df, ["action", "state"]).collect()}
    assert got == {0: 3.0, 1: 1.0}
    assert tuple(profile.vector_mean_wide(df, "state", 2).first()) == (3.0, 1.0)


def test_samples(spark):
    df = spark.range(400).select((F.col("id") / 4).cast("long").alias("e"), (F.col("id") % 4).alias("step_index"))
    one, again, other = ({r.e for r in sample.sample_episodes(df, ["e"], 10, s).collect()} for s in (1, 1, 2))
    assert one == again != other and len(one) == 10
    assert sample.sampled_steps(df.repartition(7), ["e"], 10, 1).count() == 40
    assert sample.sample_episodes(df, ["e"], 1000).count() == 100


def test_captions(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 1, "b")], "e int, step_index int, t string")
    assert profile.captions(df, ["e"], "t").first().caption == "b (temp. downsampled 4x)"


# --- images


def test_weights():
    w = images.weights(64, 128)
    assert (np.abs(w.sum(1) - (1 << images.BITS)) <= 1).all() and ((w != 0).sum(1) <= 6).all()
    assert (w[::-1, ::-1] == w).all()
    for v in (0, 1, 127, 254, 255):
        assert (images.resized(np.full((64, 64, 3), v, np.uint8), 128, 128) == v).all()
    rough = images.resized((np.indices((8, 8)).sum(0) % 2 * 255).astype(np.uint8)[:, :, None], 16, 16)
    assert rough.shape == (16, 16, 1) and rough.dtype == np.uint8


def test_resize_of_bad_bytes(spark):
    df = spark.createDataFrame([(b"\0" * 12,), (b"\0",), (None,)], "b binary")
    assert [None if r.x is None else len(r.x) for r in df.select(images.resize(F.col("b"), (2, 2, 3), (4, 4)).alias("x")).collect()] == [48, None, None]


def test_png():
    import zlib

    x = np.random.Generator(np.random.PCG64(1)).integers(0, 256, (5, 7, 3)).astype(np.uint8)
    assert images.from_png(images.to_png(x.tobytes(), 5, 7)) == (x.tobytes(), 5, 7)
    png = images.to_png(x.tobytes(), 5, 7)
    for kind in (1, 2, 3, 4):  # the filters that other writers use
        rows, up = b"", np.zeros(21 + 3, int)
        for y in range(5):
            line = np.concatenate([[0, 0, 0], x[y].ravel().astype(int)])
            guess = [{1: a, 2: b, 3: (a + b) // 2, 4: min((a, b, c), key=lambda v: abs(a + b - c - v))}[kind] for a, b, c in zip(line[:-3], up[3:], up[:-3], strict=True)]
            rows += bytes([kind]) + bytes(((line[3:] - guess) & 255).tolist())
            up = line
        body = zlib.compress(rows)
        chunk = struct.pack(">I", len(body)) + b"IDAT" + body + struct.pack(">I", zlib.crc32(b"IDAT" + body))
        assert images.from_png(png[:33] + chunk)[0] == x.tobytes()
    with pytest.raises(ValueError, match="PNG"):
        images.from_png(b"nothing")


def test_strip(spark):
    frames = [bytes(range(i, i + 12)) for i in (0, 100)]
    df = spark.createDataFrame([(frames,)], "f array<binary>")
    out = df.select(images.strip(F.col("f"), (2, 2, 3)).alias("s")).first().s
    assert bytes(out) == frames[0][:6] + frames[1][:6] + frames[0][6:] + frames[1][6:]


# --- embeddings


def test_embedding_sees_each_text_once(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "t string")
    out = embed.embed_distinct(df, "t", embed.HashEmbedder(4), "v").collect()
    by: dict = {}
    for r in out:
        by.setdefault(r.t, set()).add(None if r.v is None else tuple(r.v))
    assert len(out) == 4 and all(len(v) == 1 for v in by.values()) and by["a"] != by["b"] and by[None] == {None}
    assert all(-1 <= x <= 1 for x in next(iter(by["a"])))


# --- sources and sinks


def save(path, steps):
    a = np.empty(len(steps), object)
    a[:] = steps
    np.save(path, a, allow_pickle=True)


@pytest.fixture
def recordings(tmp_path):
    rng = np.random.Generator(np.random.PCG64(3))
    for split in ("train", "val"):
        (tmp_path / split).mkdir()
        for i in range(3):
            save(tmp_path / split / f"episode_{i}.npy", [{"image": rng.integers(0, 255, (64, 64, 3)).astype(np.uint8), "wrist_image": rng.integers(0, 255, (64, 64, 3)).astype(np.uint8), "state": rng.random(10).astype(np.float32), "action": rng.random(10).astype(np.float32), "language_instruction": f"do {i}"} for _ in range(i)])
    return tmp_path


def test_recordings(spark, recordings):
    steps = npy.read(spark, f"file://{recordings}/train/episode_*.npy").collect()
    assert sorted((r.episode_id[-5], r.step_index) for r in steps) == [("1", 0), ("2", 0), ("2", 1)]
    assert all(len(r.image) == 12288 and len(r.state) == 10 for r in steps)
    assert npy.episode_paths(spark, f"file://{recordings}/train/episode_*.npy").count() == 3


def test_evil_recordings(tmp_path):
    class Evil:
        def __reduce__(self):
            return (print, ("ran",))

    save(tmp_path / "evil.npy", [{"image": Evil()}])
    with pytest.raises(Exception, match="not allowed"):
        npy.decode((tmp_path / "evil.npy").read_bytes())
    np.save(tmp_path / "plain.npy", np.zeros(3))
    for content in (b"x", (tmp_path / "plain.npy").read_bytes()):
        with pytest.raises(ValueError):
            npy.decode(content)


def test_build_validate_profile(spark, recordings, capsys):
    from quillon import cli

    out = f"file://{recordings}/out"
    build = ["build", out, "--split", f"train=file://{recordings}/train/*.npy", "--split", f"val=file://{recordings}/val/*.npy"]
    assert cli.main(build) == 0
    with pytest.raises(Exception, match="(?i)already exists"):
        cli.main(build)
    assert cli.main([*build, "--overwrite"]) == 0
    stored = dataset.read(spark, out)
    assert stored.count() == 6 and dataset.read(spark, out, table="episodes").where("n_steps = 0").count() == 2
    assert stored.schema["action"].metadata["shape"] == [10]
    plan = dataset.read(spark, out, "val").select("action")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan and "wrist_image" not in plan
    assert cli.main(["validate", out, "--split", "train"]) == 0
    assert cli.main(["validate", out, "--episodes", "2", "--seed", "1"]) == 0
    assert cli.main(["profile", out]) == 0
    assert "passed" in capsys.readouterr().out
    dataset.register("mine", out)
    assert dataset.find("mine") == out
    with pytest.raises(KeyError):
        dataset.find("other")


def test_duplicate_steps_are_refused(spark, tmp_path):
    s = synthetic.episodes(spark, {"train": 1}, steps=2)
    s = embed.embed_distinct(episodes.derive_flags(s, dataset.KEYS), "language_instruction", embed.HashEmbedder(), "language_embedding")
    with pytest.raises(ValueError, match="duplicate"):
        dataset.write(s.union(s), f"file://{tmp_path}/x", EpisodeSchema())


def test_schema():
    s = EpisodeSchema().without_feature("state").with_feature(Feature("audio", "float32", "Microphone.", (100,)))
    assert "state" not in s.flat().fieldNames() and s.flat()["audio"].metadata["shape"] == [100]
    assert s.nested()["steps"].dataType.elementType["observation"].dataType.fieldNames() == ["image", "wrist_image"]
    for bad in (lambda: s.without_feature("action"), lambda: s.with_feature(Feature("audio", "text", "x")), lambda: Feature("x", "text", "").field()):
        with pytest.raises(ValueError):
            bad()
    with pytest.raises(KeyError):
        s.without_feature("nothing")


def test_synthetic_is_reproducible(spark):
    a, b = (synthetic.episodes(spark, {"train": 3}, seed=4).repartition(n).orderBy("episode_id", "step_index").collect() for n in (1, 5))
    assert a == b and len(a) == 30
    assert max(max(r.image) for r in a) <= 254 and all(0 <= x < 1 for r in a for x in r.action)


def test_streaming_ingest(spark, recordings):
    folder, out, marks = f"file://{recordings}/train", f"file://{recordings}/stream", f"file://{recordings}/marks"
    ingest.ingest(spark, folder, out, marks).awaitTermination()
    assert spark.read.parquet(out).count() == 3
    save(recordings / "train" / "episode_9.npy", [{"action": np.zeros(10), "language_instruction": "late"}] * 4)
    ingest.ingest(spark, folder, out, marks).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 7
    late = got.where("language_instruction = 'late'").orderBy("step_index").collect()
    assert [r.is_last for r in late] == [False, False, False, True] and late[0].image is None


# --- queries


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_sql(spark, sf_dir, name):
    import duckdb

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, want.fetchall())) == sorted(repr(tuple(r)) for r in got.select(*columns).collect())

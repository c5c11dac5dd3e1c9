"""Recordings, stored datasets and record files: round trips, commits and pruning."""

import io
import struct
import subprocess
import sys

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillon import cli
from quillon.functions import embed
from quillon.plans.schema import EpisodeSchema, Feature
from quillon.sources import dataset, npy, store, tfrecord


def episodes_of(spark, lengths, images=True):
    rng = np.random.Generator(np.random.PCG64(3))
    rows = []
    for e, n in enumerate(lengths):
        for i in range(n):
            frame = rng.integers(0, 255, 48).astype(np.uint8).tobytes() if images else None
            rows.append((f"e/{e} ü", i, frame, None, rng.random(4).tolist(), rng.random(3).tolist(), f"do {e}"))
    return spark.createDataFrame(rows, f"episode_id string, step_index long, {npy.FIELDS}")


def names(df):
    return [r.episode_id.rsplit("/", 1)[1] for r in df.select("episode_id").distinct().collect()]


def test_recordings_round_trip(spark, tmp_path):
    path = f"file://{tmp_path}/r"
    steps = episodes_of(spark, [3, 1, 5]).repartition(4)
    npy.write(steps, path)
    assert not [p for p in (tmp_path / "r").rglob("*") if "_staging" in str(p)]
    back = npy.scan(spark, path, npy.ALL)
    assert sorted(names(back)) == sorted(npy.file_name(f"e/{e} ü") for e in range(3))
    assert npy.file_name("episode_7") == "episode_7.npy" and npy.file_name("a/b") != npy.file_name("a_b")
    key = lambda r: (r.language_instruction, r.step_index)
    for a, b in zip(sorted(steps.collect(), key=key), sorted(back.collect(), key=key), strict=True):
        assert (a.step_index, a.image, a.wrist_image, a.language_instruction) == (b.step_index, b.image, None, b.language_instruction)
        assert np.array_equal(np.float32(a.action), np.float32(b.action)) and np.array_equal(np.float32(a.state), np.float32(b.state))
        n = [3, 1, 5][int(a.language_instruction[3:])]
        assert (b.n_steps, b.is_first, b.is_last, b.is_terminal, b.reward, b.discount) == (n, a.step_index == 0, a.step_index == n - 1, a.step_index == n - 1, float(a.step_index == n - 1), 1.0)
    assert npy.scan(spark, path, ["is_terminal", "reward"], demo=False).where("is_terminal OR reward > 0").count() == 0
    plain = npy.read(spark, f"{path}/*/*.npy", npy.ALL)
    assert sorted(map(str, plain.drop("episode_id").collect())) == sorted(map(str, back.drop("episode_id").collect()))


def test_what_is_not_declared_is_not_built(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/r"
    npy.write(episodes_of(spark, [2, 2]), path)
    assert npy.scan(spark, path, ["state"]).schema.fieldNames() == ["state"]
    built = []
    monkeypatch.setattr(npy, "_cell", lambda x, kind: built.append(kind))
    for file, _, _ in store.listed(path):
        for b in npy.batches_of(file, open(file[7:], "rb").read(), ["state", "step_index"]):
            assert b.schema.names == ["state", "step_index"]
    assert set(built) == {npy._ARROW["state"]} and len(built) == 4
    with pytest.raises(Exception, match="no column"):
        spark.read.format("recordings").schema("reward double").load(path).collect()


def test_partitions_and_filters(spark, tmp_path):
    path = f"file://{tmp_path}/r"
    npy.write(episodes_of(spark, [2] * 9), path)
    files = store.listed(path)
    parts = list(store.shared_out(files, files[0][1] * 2 + 10))
    assert [x for p in parts for x in p] == [x for x, _, _ in files] and max(map(len, parts)) == 2
    assert npy.scan(spark, path).rdd.getNumPartitions() == 1
    small = spark.read.format("recordings").schema("step_index long").option("partitionBytes", files[0][1]).load(path)
    assert small.rdd.getNumPartitions() == 9 and small.count() == 18
    reader = npy._Reader(["step_index"], path, None, True)
    left = list(reader.pushFilters([npy.EqualTo(("episode_id",), files[4][0]), npy.EqualTo(("step_index",), 1)]))
    assert [x.paths for x in reader.partitions()] == [[files[4][0]]] and left == [npy.EqualTo(("step_index",), 1)]
    one = npy.scan(spark, path).where(F.col("episode_id") == files[4][0])
    assert one.count() == 2 and one.where("step_index = 1").count() == 1


def test_bytes_of_partitions():
    files = [(str(i), 3 << 20, 0) for i in range(640)]
    assert store.part_bytes(files, None, 1 << 27) == 30 << 20 and store.part_bytes(files, "7", 1 << 27) == 7
    assert store.part_bytes(files * 100, None, 1 << 27) == 1 << 27 and store.part_bytes(files[:1], None, 1 << 27) == store.LEAST_PART


def test_a_batch_is_bounded(monkeypatch):
    steps = np.empty(10, object)
    steps[:] = [{"image": np.full(1000, i, np.uint8)} for i in range(10)]
    out = io.BytesIO()
    np.save(out, steps, allow_pickle=True)
    monkeypatch.setattr(npy, "BATCH_BYTES", 5000)
    got = list(npy.batches_of("p", out.getvalue(), ["step_index", "image", "is_last"]))
    assert [b.num_rows for b in got] == [2] * 5 and [x for b in got for x in b.column(0).to_pylist()] == list(range(10))
    assert [x for b in got for x in b.column(2).to_pylist()] == [False] * 9 + [True]


def test_no_recordings(spark, tmp_path):
    assert npy.scan(spark, f"file://{tmp_path}/none").count() == 0
    npy.write(episodes_of(spark, []), f"file://{tmp_path}/none")
    assert npy.scan(spark, f"file://{tmp_path}/none").count() == 0


def test_overwrite_and_failed_writes(spark, tmp_path):
    path = f"file://{tmp_path}/r"
    npy.write(episodes_of(spark, [1, 2]), path)
    npy.write(episodes_of(spark, [4]), path)
    assert npy.scan(spark, path).count() == 7
    bad = episodes_of(spark, [2, 2, 2]).withColumn("language_instruction", F.when(F.col("episode_id") == "e/2 ü", F.raise_error(F.lit("broken"))).otherwise("x"))
    with pytest.raises(Exception, match="broken"):
        npy.write(bad, path, overwrite=True)
    assert npy.scan(spark, path).count() == 7 and not (tmp_path / "r" / "_staging").exists()
    npy.write(episodes_of(spark, [3]), path, overwrite=True)
    assert npy.scan(spark, path).count() == 3
    with pytest.raises(Exception, match="not \\['reward'\\]"):
        npy.write(episodes_of(spark, [1]), path) or spark.range(1).selectExpr("'a' episode_id", "id reward").write.format("recordings").mode("append").save(path)


def test_stream_of_recordings(spark, tmp_path):
    path, out, marks = (f"file://{tmp_path}/{x}" for x in ("r", "out", "marks"))
    npy.write(episodes_of(spark, [2, 3]), path)
    spark.dataSource.register(npy.Recordings)

    def run():
        stream = spark.readStream.format("recordings").schema("episode_id string, step_index long, is_last boolean").load(path)
        q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", marks).trigger(once=True).start()
        q.awaitTermination()

    run()
    assert spark.read.parquet(out).count() == 5
    npy.write(episodes_of(spark, [4]), path)
    run()
    got = spark.read.parquet(out)
    assert got.count() == 9 and got.where("is_last").count() == 3


# --- datasets


SMALL = EpisodeSchema(steps=(Feature("image", "uint8", "Camera.", (4, 4, 3), "png"), Feature("action", "float32", "Action.", (3,)), Feature("language_instruction", "text", "Text.")))


def small(spark, lengths, split="train"):
    return episodes_of(spark, lengths).withColumn("split", F.lit(split))


def test_images_are_stored_as_png(spark, tmp_path):
    path, steps = f"file://{tmp_path}/d", small(spark, [2, 3])
    made = dataset.write(steps, path, SMALL)
    assert made.splits == {"train": {"n_episodes": 2, "n_steps": 5, "n_bytes": made.splits["train"]["n_bytes"]}, "val": {"n_episodes": 0, "n_steps": 0, "n_bytes": 0}}
    raw = spark.read.parquet(f"{path}/{made.data}/steps")
    assert raw.schema["image"].metadata["encoding"] == "png"
    stored = raw.collect()
    assert all(bytes(r.image[:8]) == b"\x89PNG\r\n\x1a\n" for r in stored) and sum(len(r.image) for r in stored) == made.splits["train"]["n_bytes"]
    back = dataset.read(spark, path)
    assert back.schema["image"].metadata["encoding"] == "" and back.schema["image"].metadata["shape"] == [4, 4, 3]
    key = lambda r: (r.episode_id, r.step_index)
    assert [r.image for r in sorted(back.collect(), key=key)] == [r.image for r in sorted(steps.collect(), key=key)]
    plan = back.select("action")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "image" not in plan.split("ReadSchema")[-1]
    assert [tuple(r) for r in dataset.summary(spark, path).orderBy("split").collect()] == [("train", 2, 5, made.splits["train"]["n_bytes"]), ("val", 0, 0, 0)]


def test_versions(spark, tmp_path):
    path = f"file://{tmp_path}/d"
    with pytest.raises(FileNotFoundError):
        dataset.read(spark, path)
    dataset.write(small(spark, [2]), path, SMALL)
    with pytest.raises(FileExistsError, match="already exists"):
        dataset.write(small(spark, [9]), path, SMALL)
    two = dataset.write(small(spark, [3], "val"), path, SMALL, overwrite=True, description="second")
    assert two.number == 2 and dataset.version(spark, path).description == "second"
    assert dataset.read(spark, path).count() == 3 and dataset.read(spark, path, number=1).count() == 2
    assert dataset.read(spark, path, "train").count() == 0 and dataset.read(spark, path, "val").count() == 3
    assert dataset.vacuum(spark, path) == [1] and dataset.versions(spark, path) == [2]
    assert dataset.read(spark, path).count() == 3 and len(list((tmp_path / "d" / "data").iterdir())) == 1
    with pytest.raises(FileNotFoundError):
        dataset.read(spark, path, number=1)


def test_a_killed_write_leaves_the_old_version(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/d"
    dataset.write(small(spark, [2, 2]), path, SMALL)
    before = sorted(map(str, dataset.read(spark, path).collect()))
    bad = small(spark, [3, 3]).withColumn("language_instruction", F.when(F.col("step_index") == 2, F.raise_error(F.lit("broken"))).otherwise("x"))
    with pytest.raises(Exception, match="broken"):
        dataset.write(bad, path, SMALL, overwrite=True)
    with pytest.raises(ValueError, match="duplicate"):
        dataset.write(small(spark, [3]).union(small(spark, [3])), path, SMALL, overwrite=True)
    with pytest.raises(ValueError, match="no split"):
        dataset.write(small(spark, [3], "other"), path, SMALL, overwrite=True)
    assert len(list((tmp_path / "d" / "data").iterdir())) == 1  # what failed is gone

    def killed(self, name, text):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:  # a process that dies before its entry, and cannot clean up
        m.setattr(store.Files, "publish", killed)
        m.setattr(store.Files, "delete", lambda self, name: None)
        with pytest.raises(KeyboardInterrupt):
            dataset.write(small(spark, [7]), path, SMALL, overwrite=True)
    assert sorted(map(str, dataset.read(spark, path).collect())) == before and dataset.versions(spark, path) == [1]
    assert len(list((tmp_path / "d" / "data").iterdir())) == 2
    dataset.vacuum(spark, path)
    assert len(list((tmp_path / "d" / "data").iterdir())) == 1 and dataset.read(spark, path).count() == 4


def test_one_of_two_writers_succeeds(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/d"
    dataset.write(small(spark, [1]), path, SMALL)
    publish = store.Files.publish

    def late(self, name, text):  # another has just made the version
        assert publish(self, name, text.replace('"description": ""', '"description": "first"'))
        return publish(self, name, text)

    with monkeypatch.context() as m:
        m.setattr(store.Files, "publish", late)
        with pytest.raises(FileExistsError, match="another writer"):
            dataset.write(small(spark, [2]), path, SMALL, overwrite=True)
    assert dataset.version(spark, path).description == "first"


def test_steps_are_computed_once(spark, tmp_path):
    path, seen = f"file://{tmp_path}/d", spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    steps = small(spark, [2, 3])
    names = steps.select("split", "episode_id").distinct().withColumn("file_path", F.col("episode_id"))
    extra = spark.createDataFrame([("val", "empty", "p")], names.schema)
    made = dataset.write(steps.mapInArrow(run, steps.schema), path, SMALL, names.union(extra))
    assert seen.value == 5 and made.splits["val"] == {"n_episodes": 1, "n_steps": 0, "n_bytes": 0}
    assert sorted(r.n_steps for r in dataset.read(spark, path, table="episodes").collect()) == [0, 2, 3]
    assert made.schema["fields"][3]["metadata"]["shape"] == [4, 4, 3]


def test_catalogue(spark, tmp_path):
    folder = f"file://{tmp_path}/names"
    with pytest.raises(KeyError):
        dataset.Catalogue(spark, folder).find("mine")
    dataset.Catalogue(spark, folder).register("mine", "file:///a")
    dataset.Catalogue(spark, folder).register("mine", "file:///b")
    dataset.Catalogue(spark, folder).register("other-1", "file:///c")
    assert dataset.Catalogue(spark, folder).find("mine") == "file:///b" and dataset.Catalogue(spark, folder).names() == ["mine", "other-1"]
    for bad in ("", "a/b", ".."):
        with pytest.raises(ValueError):
            dataset.Catalogue(spark, folder).register(bad, "x")


def test_names_in_a_new_process(spark, tmp_path, capsys):
    path, folder = f"file://{tmp_path}/out", f"file://{tmp_path}/names"
    steps = episodes_of(spark, [2, 1], images=False).withColumn("image", F.expr(f"unhex(repeat('1f', {64 * 64 * 3}))"))
    steps = steps.withColumns({c: F.expr("cast(array_repeat(0.5, 10) as array<float>)") for c in ("state", "action")}).withColumn("wrist_image", F.col("image"))
    npy.write(steps, f"file://{tmp_path}/raw")
    assert cli.main(["build", path, "--split", f"train=file://{tmp_path}/raw/*/*.npy", "--name", "mine", "--catalogue", folder]) == 0
    assert "version 1" in capsys.readouterr().out
    code = "import sys; from quillon import cli; sys.exit(cli.main(sys.argv[1:]))"
    got = subprocess.run([sys.executable, "-c", code, "validate", "mine", "--catalogue", folder], capture_output=True, text=True, timeout=300)
    assert got.returncode == 0 and "passed" in got.stdout


def test_build_shuffles_no_image(spark, tmp_path):
    npy.write(episodes_of(spark, [2, 3]), f"file://{tmp_path}/raw")
    given = f"file://{tmp_path}/raw/*/*.npy"
    for most in (1 << 20, 0):  # vectors that are broadcast, and too many for it
        steps = embed.embed_in_place(npy.read(spark, given, npy.ALL), npy.read(spark, given, ["language_instruction"]), "language_instruction", embed.HashEmbedder(4), "language_embedding", most)
        plan = steps._jdf.queryExecution().executedPlan().toString()
        assert not [x for x in plan.split("\n") if "Exchange hash" in x and "image" in x] and "SortMergeJoin" not in plan
        assert all(len(r.language_embedding) == 4 for r in steps.collect())


# --- record files


def crc32c(data):
    """A bit at a time."""
    crc = 0xFFFFFFFF
    for b in data:
        crc ^= b
        for _ in range(8):
            crc = crc >> 1 ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def masked(data):
    crc = crc32c(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


@settings(max_examples=30, deadline=None)
@given(st.lists(st.binary(max_size=70), max_size=6))
def test_checksums(records):
    assert crc32c(b"123456789") == 0xE3069283  # the check value of the code's definition
    block, tfrecord.BLOCK = tfrecord.BLOCK, 16
    tfrecord._over_block.cache_clear()
    try:
        assert tfrecord.masked_crcs(records).tolist() == [masked(r) for r in records]
    finally:
        tfrecord.BLOCK = block
        tfrecord._over_block.cache_clear()


def test_checksums_of_long_records():
    r = np.random.default_rng(1)
    records = [r.integers(0, 256, n).astype(np.uint8).tobytes() for n in (0, 1, 1023, 1024, 1025, 9000)]
    assert tfrecord.masked_crcs(records).tolist() == [masked(x) for x in records]


EXAMPLES = "id long, small int, yes boolean, word string, raw binary, one float, many array<float>, counts array<long>, flags array<boolean>, words array<string>"


def test_record_files_round_trip(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    rows = [
        (2**63 - 1, -5, True, "ü\n", b"\x00\xff", 0.1, [1.5, -0.0, 3e38], [-(2**63), 0, 300], [True, False], ["", "é"]),
        (None,) * 10,
        (0, 0, False, "", b"", float("inf"), [], [], [], []),
        *[(i, i, i % 2 == 0, "x" * i, bytes([i]) * (100 * i), float(i), [float(i)] * i, [i] * i, [True] * i, ["w"] * i) for i in range(40)],
    ]
    df = spark.createDataFrame(rows, EXAMPLES).repartition(3)
    tfrecord.write(df, path)
    back = tfrecord.read(spark, path, EXAMPLES)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert sorted(r.word or "" for r in tfrecord.read(spark, path, "word string").collect()) == sorted(r[3] or "" for r in rows)
    assert tfrecord.read(spark, path, "absent float").where("absent IS NOT NULL").count() == 0
    tfrecord.write(df.limit(2), path, overwrite=True)
    assert tfrecord.read(spark, path, EXAMPLES).count() == 2
    tfrecord.write(df.limit(0), path, overwrite=True)
    assert tfrecord.read(spark, path, EXAMPLES).count() == 0
    for columns, error in (("x double", "do not hold"), ("x map<string,int>", "do not hold")):
        with pytest.raises(Exception, match=error):
            tfrecord.write(spark.createDataFrame([], columns), path)
    with pytest.raises(Exception, match="no null within"):
        tfrecord.write(spark.createDataFrame([([1.0, None],)], "x array<float>"), path)
    with pytest.raises(Exception, match="declare the columns"):
        spark.read.format("tfrecord").load(path)


def test_bytes_of_a_record():
    """Spelt out by hand: a length, its checksum, {"a": ints [3]}, its checksum."""
    message = bytes([0x0A, 0x0C, 0x0A, 0x0A, 0x0A, 1, ord("a"), 0x12, 5, 0x1A, 3, 0x0A, 1, 3])
    assert tfrecord.example({"a": 3}, {"a": (3, False)}) == message
    head = struct.pack("<Q", 14)
    assert tfrecord.framed([message]) == head + struct.pack("<I", masked(head)) + message + struct.pack("<I", masked(message))
    apart = bytes([0x0A, 0x0E, 0x0A, 0x0C, 0x0A, 1, ord("a"), 0x12, 7, 0x1A, 5, 0x08, 3, 0x08, 0xAC, 0x02])  # not packed
    assert tfrecord.parsed(apart, {"a"}) == {"a": (3, [3, 300])}
    assert tfrecord.parsed(message, {"b"}) == {}


def test_broken_record_files(spark, tmp_path):
    tfrecord.write(spark.createDataFrame([(i, "x" * 50) for i in range(9)], "id long, s string").coalesce(1), f"file://{tmp_path}/t")
    file = next((tmp_path / "t").rglob("*.tfrecord"))
    whole = file.read_bytes()
    for at, error in ((0, "bad checksum in the record at byte 0"), (20, "at byte 0"), (len(whole) - 1, "bad checksum"), (None, "cut off")):
        broken = whole[:-3] if at is None else whole[:at] + bytes([whole[at] ^ 1]) + whole[at + 1 :]
        with pytest.raises(ValueError, match=error):
            list(tfrecord.unframed(io.BytesIO(broken), "f"))
    file.write_bytes(whole[:-3])
    with pytest.raises(Exception, match="cut off"):
        tfrecord.read(spark, f"file://{tmp_path}/t", "id long").collect()
    assert [len(x) for x in tfrecord.unframed(io.BytesIO(whole), "f", 100)] == [2, 2, 2, 2, 1]


def test_files_of_bounded_size(spark, tmp_path):
    df = spark.createDataFrame([(i, "x" * 1000) for i in range(50)], "id long, s string").coalesce(1)
    spark.dataSource.register(tfrecord.TFRecords)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        df.write.format("tfrecord").option("fileBytes", 25000).mode("append").save(f"file://{tmp_path}/t")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(store.listed(f"file://{tmp_path}/t")) == 3
    few = spark.read.format("tfrecord").schema("id long").option("partitionBytes", 1).load(f"file://{tmp_path}/t")
    assert few.rdd.getNumPartitions() == 3 and few.count() == 50

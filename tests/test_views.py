"""Views compiled from schemas, orders of epochs, stored vectors, counts in a pass."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.functions import embed, lexical
from quillon.operators import episodes, sample
from quillon.plans import nesting, spec
from quillon.plans.schema import EpisodeSchema, Feature
from quillon.sources import synthetic

SCHEMA = EpisodeSchema(
    steps=(Feature("image", "uint8", "Camera.", (2, 2, 3), "png"), Feature("depth", "uint8", "Depth.", (2, 2, 3), "png", True), Feature("state", "float32", "State.", (2,)), Feature("action", "float32", "Action.", (2,)), Feature("done", "bool", "Done.")),
    metadata=(Feature("file_path", "text", "Path."), Feature("robot", "text", "Robot.", optional=True)),
)


@pytest.fixture
def steps(spark):
    rows = [("train", e, i, bytes([i] * 12), [float(i), 1.0], [0.5, float(i)], i == 2) for e in ("a", "b") for i in range(3)]
    return spark.createDataFrame(rows, "split string, episode_id string, step_index long, image binary, state array<double>, action array<float>, done boolean")


def test_nested_view_and_back(spark, steps):
    listed = spark.createDataFrame([("train", "a", "/a"), ("train", "b", "/b"), ("val", "none", "/c")], "split string, episode_id string, file_path string")
    nested = nesting.nested_view(steps, SCHEMA, listed)
    assert [f.dataType.simpleString() for f in nested.schema] == [f.dataType.simpleString() for f in SCHEMA.nested()]
    got = {r.episode_id: r for r in nested.collect()}
    assert [s.action[1] for s in got["a"].steps] == [0.0, 1.0, 2.0] and got["none"].steps == [] and got["b"].episode_metadata.file_path == "/b"
    assert got["a"].steps[1].observation.state == [1.0, 1.0] and got["a"].steps[1].observation.depth is None and got["a"].episode_metadata.robot is None
    flat = nesting.flat_view(nested, SCHEMA)
    assert flat.columns == ["split", "episode_id", "step_index", "image", "depth", "state", "action", "done"]
    assert flat.schema["image"].metadata["shape"] == [2, 2, 3]
    key = lambda r: (r.episode_id, r.step_index)
    shown = steps.withColumns({"depth": F.lit(None).cast("binary"), "state": F.col("state").cast("array<float>")}).select(flat.columns)
    assert sorted(flat.collect(), key=key) == sorted(shown.collect(), key=key)
    assert [tuple(r) for r in nesting.episode_view(nested, SCHEMA).where("n_steps = 0").collect()] == [("val", "none", "/c", None, 0)]
    assert nesting.nested_view(steps, SCHEMA).where("episode_metadata.file_path IS NULL").count() == 2


def test_features_that_come_and_go(spark, steps):
    more = SCHEMA.with_feature(Feature("grip", "float", "Grip.")).with_feature(Feature("site", "text", "Site.", optional=True), "metadata")
    with pytest.raises(ValueError, match="missing feature: grip"):
        nesting.nested_view(steps, more)
    nested = nesting.nested_view(steps.withColumn("grip", F.col("step_index") / 2), more)
    assert sorted(r.grip for r in nesting.flat_view(nested, more).collect()) == [0.0, 0.0, 0.5, 0.5, 1.0, 1.0]
    assert nested.schema["episode_metadata"].dataType.fieldNames() == ["file_path", "robot", "site"]
    less = SCHEMA.without_feature("depth").without_feature("done")
    assert "done" not in nesting.flat_view(nested, less).columns
    with pytest.raises(ValueError, match="has no grip"):
        nesting.flat_view(nesting.nested_view(steps, SCHEMA), more)


# --- orders


def test_an_order_is_a_bijection(spark):
    for n in (0, 1, 2, 3, 7, 64, 101, 1000):
        seen = []
        for epoch in (0, 1):
            got = [r.p for r in spark.range(n).select("id", sample.permuted(F.col("id"), n, 3, epoch).alias("p")).orderBy("id").collect()]
            assert sorted(got) == list(range(n))
            seen.append(got)
        assert n < 50 or (seen[0] != seen[1] and sum(a == i for i, a in enumerate(seen[0])) < n / 10)


def test_an_order_is_even(spark):
    """Over many epochs a row comes to all parts of the order."""
    n, epochs = 20, 60
    total = [0] * n
    for e in range(epochs):
        for r in spark.range(n).select("id", sample.permuted(F.col("id"), n, 1, e).alias("p")).collect():
            total[r.id] += r.p
    assert all(abs(t / epochs - (n - 1) / 2) < 4 * 5.77 / epochs**0.5 for t in total)


def test_numbers_of_rows(spark):
    df = spark.createDataFrame([(x,) for x in (5, 3, None, 9, 7, 1)], "k int").repartition(3)
    assert {r.k: r.row for r in sample.number_rows(df, ["k"]).collect()} == {None: 0, 1: 1, 3: 2, 5: 3, 7: 4, 9: 5}
    order = sample.epoch_order(df, ["k"], seed=2, epoch=1)
    assert order.columns == ["k", "place"] and sorted(r.place for r in order.collect()) == list(range(6))
    plan = order._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Sort" not in plan


# --- vectors


class Counting(embed.HashEmbedder):
    """Notes which texts the model sees."""

    def __init__(self, seen, size):
        super().__init__(size)
        self.seen = seen

    def column(self, text):
        seen, size = self.seen, self.size

        @F.pandas_udf("array<float>")
        def run(texts):
            seen.add(list(texts))
            return texts.map(lambda t: [float(len(t))] * size)

        return run(text)


def test_a_second_build_embeds_new_texts_only(spark, tmp_path):
    from pyspark.accumulators import AccumulatorParam

    class Lists(AccumulatorParam):
        def zero(self, value):
            return []

        def addInPlace(self, a, b):  # noqa: N802
            return a + b

    seen = spark.sparkContext.accumulator([], Lists())
    folder = f"file://{tmp_path}/vectors"
    texts = lambda *x: spark.createDataFrame([(t,) for t in x], "t string")
    first = embed.EmbeddingStore(spark, folder, Counting(seen, 2), "count")
    assert first.add(texts("a", "bb", "a", None), "t") == 2 and sorted(seen.value) == ["a", "bb"]
    again = embed.EmbeddingStore(spark, folder, Counting(seen, 2), "count")  # as a later process would
    out = again.embed(texts("bb", "ccc", None, "bb"), "t", "v")
    assert sorted((r.t or "", r.v) for r in out.collect()) == [("", None), ("bb", [2.0, 2.0]), ("bb", [2.0, 2.0]), ("ccc", [3.0, 3.0])]
    assert sorted(seen.value) == ["a", "bb", "ccc"] and again.vectors().count() == 3
    assert again.add(texts("a", None), "t") == 0 and len(seen.value) == 3
    with pytest.raises(ValueError, match="count/2"):
        embed.EmbeddingStore(spark, folder, embed.HashEmbedder(4), "hash")


def test_two_writers_of_a_store(spark, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}/vectors"
    one, two = (embed.EmbeddingStore(spark, folder, embed.HashEmbedder(2), "hash") for _ in range(2))
    texts = spark.createDataFrame([("a",), ("b",)], "t string")
    publish = embed.Files.publish

    def late(self, name, text):  # the other writer is faster, once
        with monkeypatch.context() as m:
            m.setattr(embed.Files, "publish", publish)
            two.add(texts.where("t = 'a'"), "t")
        return publish(self, name, text)

    monkeypatch.setattr(embed.Files, "publish", late)
    assert one.add(texts, "t") == 1
    assert sorted(r.text for r in one.vectors().collect()) == ["a", "b"]


# --- counts


def test_counts_in_the_pass(spark):
    kept, seen = episodes.skip_in_pass(spark.createDataFrame([(1.0,), (None,), (9.0,)], "v double"), F.col("v") > 5)
    assert kept.count() == 1 and seen.get == {"kept": 1, "skipped": 2}
    df = spark.createDataFrame([([0.0] * 8,), ([5.0] * 8,), (None,)], "action array<float>")
    out, counts = spec.observed(df, {"action": spec.TARGET["action"]})
    assert out.count() == 3 and counts.get == {"n_rows": 3, "n_bad_rows": 2}
    with pytest.raises(TypeError):
        spec.observed(df, spec.TARGET)
    report = {(r.field, r.check) for r in spec.schema_report(df, spec.TARGET).collect()}
    assert ("reward", "missing") in report and ("action", "dtype") not in report
    assert spec.first_violation(df.withColumn("k", F.lit(1)), {"action": spec.TARGET["action"]}, ["k"]).collect()[0].check == "shape"


def test_episodes_for_rows(spark):
    rows = spark.createDataFrame([(1, 3), (2, 0), (3, None)], "k long, n int")
    a, b = (sorted(map(str, synthetic.for_rows(rows.repartition(p), "k", F.col("n"), {"state": 4}, 1, (2, 2, 3)).collect())) for p in (1, 3))
    assert a == b and len(a) == 3
    got = synthetic.for_rows(rows, "k", F.col("n"), {"state": 4}, 1, (2, 2, 3)).collect()
    assert all(len(r.image) == 12 and len(r.state) == 4 and all(0 <= x < 1 for x in r.state) for r in got)


# --- a trained encoder


def test_lexical_vectors(spark):
    corpus = ["the red robot opens the drawer", "the robot closes a drawer", "the cup is on the table", "put the cup on the shelf", None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(corpus)], "id int, t string").repartition(3)
    model = lexical.train(df, "t", 256)
    assert model.weights[lexical.place("the")[2]] < model.weights[lexical.place("drawer")[2]] < model.weights[lexical.place("unseen")[2]]
    rows = {r.id: r.v for r in df.withColumn("v", model.column(F.col("t"))).collect()}
    assert rows[4] is None and set(rows[5]) == {0.0}
    v = {i: np.array(rows[i]) for i in range(4)}
    assert all(abs((x * x).sum() - 1) < 1e-5 for x in v.values())
    assert v[0] @ v[1] > max(v[0] @ v[2], v[0] @ v[3]) and v[2] @ v[3] > v[1] @ v[3]
    assert np.array_equal(model.vectors(["The RED robot"]), model.vectors(["the red robot"]))
    pair = spark.createDataFrame([(v[0].tolist(), v[1].tolist())], "a array<float>, b array<float>")
    assert abs(pair.select(lexical.similarity(F.col("a"), F.col("b")).alias("s")).first().s - v[0] @ v[1]) < 1e-6
    none = lexical.train(df.limit(0), "t", 8)
    assert set(none.weights) == {1.0} and none.vectors([]).shape == (0, 8)
    with pytest.raises(ValueError, match="weights"):
        lexical.LexicalEmbedder(np.ones(3))


def test_lexical_embedder_in_a_store(spark, tmp_path):
    df = spark.createDataFrame([("open the door",), ("close it",)], "t string")
    store = embed.EmbeddingStore(spark, f"file://{tmp_path}/v", lexical.train(df, "t", 16), "lexical")
    out = store.embed(df, "t", "v").collect()
    assert store.vectors().count() == 2 and all(len(r.v) == 16 for r in out)

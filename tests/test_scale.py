"""Operators whose tasks stay bounded, against plain versions."""

import collections
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillon.operators import dense, positions, profile


def plain_positions(rows, demo=True):
    """{(key, order): (index, first, last, terminal, reward)} of rows (key, order)."""
    out = {}
    for key in {k for k, _ in rows}:
        mine = sorted(o for k, o in rows if k == key)
        for i, o in enumerate(mine):
            last = i == len(mine) - 1
            out[key, o] = (i, i == 0, last, last and demo, float(last and demo))
    return out


def placed(df, **kw):
    out = positions.place_steps(df, ["e"], ["t"], **kw)
    rows = out.collect()
    assert out.columns == [*df.columns, "step_index", "is_first", "is_last", "is_terminal", "reward", "discount"]
    assert all(r.discount == 1.0 for r in rows)
    return {(r.e, r.t): (r.step_index, r.is_first, r.is_last, r.is_terminal, r.reward) for r in rows}


def test_positions_of_a_long_episode(spark):
    r = random.Random(4)
    rows = [("long", i) for i in range(3000)] + [(None, i) for i in range(50)] + [(f"e{r.randrange(200)}", 10_000 + i) for i in range(3000)] + [("zz", 1)]
    r.shuffle(rows)
    df = spark.createDataFrame([(e, t, "x") for e, t in rows], "e string, t long, is_it string").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        for parts in (1, 2, 16, None):
            assert placed(df, parts=parts) == plain_positions(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert placed(df, demo=False) == plain_positions(rows, False)


def test_a_long_episode_is_no_large_task(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("e"), F.col("id").alias("t"))
    out = positions.place_steps(df, ["e"], ["t"], parts=16)
    stored = spark.read.parquet(next(p for p in out.inputFiles()).rsplit("/", 1)[0])
    sizes = [r["count"] for r in stored.groupBy("q_part").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 40_000 / 16
    assert out.where("e = 0").agg(F.max("step_index")).first()[0] == 19_999 and out.where("is_last").count() == 20_001


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 7), min_size=1, max_size=6), st.lists(st.integers(1, 9), min_size=1, max_size=6))
def test_borders(lengths, cuts):
    """The two rows of each partition tell all, wherever the borders fall."""
    rows = [(e, i) for e, n in enumerate(lengths) for i in range(n)]
    parts, at = [], 0
    while at < len(rows):
        n = cuts[len(parts) % len(cuts)]
        parts.append(rows[at : at + n])
        at += n
    sent = []
    for p, part in enumerate(parts):
        runs = [part[0][0]]
        for j, (e, i) in enumerate(part):
            runs += [e] if e != runs[-1] else []
            begin = next(k for k, x in enumerate(part) if x[0] == e)
            if j in (0, len(part) - 1):
                sent.append({"q_part": 2 * p, "q_at": j, "q_place": j - begin, "q_first_run": len(runs) == 1, "q_end": j == len(part) - 1, "e": e})
    want = [(2 * p, part[0][1], p + 1 < len(parts) and parts[p + 1][0][0] == part[-1][0]) for p, part in enumerate(parts)]
    assert positions._borders(sent, ["e"]) == want


def test_positions_of_odd_tables(spark):
    assert placed(spark.createDataFrame([], "e string, t long"), parts=3) == {}
    nan = spark.createDataFrame([(float("nan"), i) for i in range(30)] + [(1.0, 0), (None, 0)], "e double, t long")
    got = positions.place_steps(nan, ["e"], ["t"], parts=4).collect()
    assert sorted(r.step_index for r in got if r.e is not None and math.isnan(r.e)) == list(range(30)) and sum(r.is_last for r in got) == 3
    with pytest.raises(ValueError, match="reserved"):
        positions.place_steps(nan.withColumn("q_at", F.lit(1)), ["e"], ["t"])


def test_last_steps(spark):
    df = spark.createDataFrame([("a", 0, "x"), ("a", 1, "y"), (None, 0, "z"), (None, 5, "w"), ("b", 3, "v")], "e string, step_index long, s string")
    assert sorted(r.s for r in positions.last_steps(df, ["e"]).collect()) == ["v", "w", "y"]
    plan = positions.last_steps(df, ["e"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


# --- dense profiles

VECTORS = st.lists(st.one_of(st.none(), st.lists(st.one_of(st.none(), st.floats(width=32), st.sampled_from([0.0, 1.0, -2.5])), max_size=4)), max_size=25)


@settings(max_examples=15, deadline=None)
@given(VECTORS)
def test_dense_equals_expanded(spark, vectors):
    df = spark.createDataFrame([(v, [1.0, 2.0]) for v in vectors], "v array<float>, w array<double>").repartition(3)

    def rows(out):
        return sorted(tuple("nan" if isinstance(x, float) and math.isnan(x) else round(x, 6) if isinstance(x, float) and abs(x) < 1e9 else x for x in r) for r in out.collect())

    for new, old in ((dense.histogram, profile.vector_histogram), (dense.nonfinite, profile.vector_nonfinite)):
        a = new(df, ["v", "w", "absent"])
        assert rows(a) == rows(old(df, ["v", "w", "absent"]).select(*a.columns))
    got = {(r.kind, r.dim): (r["mean"], r.n) for r in dense.means(df, ["v", "w"]).collect()}
    want = {(r.kind, r.dim): (r["mean"], r.n) for r in profile.vector_mean(df, ["v", "w"]).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][1] == want[k][1]
        a, b = got[k][0], want[k][0]
        assert (a is None) == (b is None) and (a is None or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-6) or a == b or math.isnan(a) and math.isnan(b))


def test_dense_plans(spark):
    df = spark.createDataFrame([([1.0, 2.0],)] * 50, "v array<double>").repartition(4)
    for out in (dense.means(df, ["v"]), dense.histogram(df, ["v"])):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Generate" not in plan and "Join" not in plan
    assert [tuple(r) for r in dense.histogram(df, ["v"]).orderBy("dim").collect()] == [("v", 0, 10, 50), ("v", 1, 10, 50)]


def test_dense_edges():
    grid = np.array([i / 100 for i in range(11)] * 3)
    edges = dense.inner_edges(grid.min(), grid.max(), 20)
    counts = collections.Counter(np.searchsorted(edges, grid, "right").tolist())
    assert [counts.get(i, 0) for i in range(20)] == np.histogram(grid, 20)[0].tolist()

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from duewise.operators.ordering import chunked, hot_keys, running
from duewise.operators.quantiles import exact_quantiles
from duewise.session import staged


def _rows(n=3000, seed=1):
    draw = random.Random(seed)
    # One key holds a third of the rows, and scores repeat heavily.
    return [(1 if i % 3 == 0 else draw.randint(2, 40), draw.randint(0, 9), i, float(draw.randint(1, 100))) for i in range(n)]


@pytest.mark.parametrize("segments", [1, 4, 64])
def test_running_is_the_same_for_any_partitioning(spark, segments):
    rows = _rows()
    df = staged(spark.createDataFrame(rows, "k int, score int, id long, v double"), "t")
    got = {r["id"]: (r["position"], r["total"]) for r in running(
        df, [F.col("score").desc(), F.col("id")], by=["k"], sums={"total": F.col("v")}, segments=segments).collect()}
    expected, state = {}, {}
    for k, s, i, v in sorted(rows, key=lambda r: (r[0], -r[1], r[2])):
        n, t = state.get(k, (0, 0.0))
        state[k] = expected[i] = (n + 1, t + v)
    assert got == expected


def test_exact_copies_spread_over_segments(spark):
    df = staged(spark.range(2000).select(F.lit(7).alias("x")), "copies")
    out = running(df, [F.col("x")], segments=8)
    assert sorted(r["position"] for r in out.collect()) == list(range(1, 2001))


def test_hot_keys_found(spark):
    df = spark.createDataFrame(_rows(), "k int, score int, id long, v double")
    assert [r["k"] for r in hot_keys(df, "k", 500).collect()] == [1]
    assert hot_keys(df, "k", 5000) is None


def test_chunks_overlap_by_the_frame(spark):
    df = staged(spark.range(25).select(F.lit(1).alias("k"), "id"), "chunk")
    rows = chunked(df, "k", [F.col("id")], before=2, after=1, chunk_rows=10).collect()
    seen = {}
    for r in rows:
        seen.setdefault(r["_chunk"], {})[r["id"]] = r["_halo"]
    assert sorted(i for i, halo in seen[1].items() if not halo) == list(range(10, 20))
    assert sorted(i for i, halo in seen[1].items() if halo) == [8, 9, 20]


def test_quantiles_are_exact_listed_or_ranked(spark):
    df = staged(spark.createDataFrame([(float(v % 37) if v % 5 else None,) for v in range(1000)], "v double"), "q")
    probabilities = {"v": [0.0, 0.01, 0.33, 0.5, 0.75, 0.99, 1.0]}
    listed = exact_quantiles(df, {"v": F.col("v")}, probabilities)
    ranked = exact_quantiles(df, {"v": F.col("v")}, probabilities, listed_values=3)
    values = np.array([v % 37 for v in range(1000) if v % 5], dtype=float)
    assert listed["v"] == ranked["v"] == {q: pytest.approx(np.quantile(values, q)) for q in probabilities["v"]}
    spread = staged(spark.range(100_000).select((F.pmod(F.xxhash64("id"), F.lit(999_983)) * 0.5).alias("v")), "spread")
    exact = np.array([r[0] for r in spread.collect()])
    for limit in (200_000, 10):
        got = exact_quantiles(spread, {"v": F.col("v")}, probabilities, listed_values=limit)["v"]
        assert got == {q: pytest.approx(np.quantile(exact, q)) for q in probabilities["v"]}
    empty = df.where(F.col("v") > 1e9)
    assert exact_quantiles(empty, {"v": F.col("v")}, {"v": [0.5]})["v"][0.5] is None

import random

import numpy as np
import pytest

from duewise.operators import profiling
from duewise.operators import quantiles as Q


def _tables(spark, n=400):
    draw = random.Random(4)
    rows = [(draw.gauss(0, 1), draw.choice([1, 2, 2, 3, None]), draw.choice([float("nan"), 5.0]), None, "x", draw.paretovariate(1.2)) for _ in range(n)]
    rows += [(float("inf"), 1, -0.0, None, None, 1e9)]
    a = spark.createDataFrame(rows, "a double, b int, c double, d double, e string, f double")
    return {"one": a, "none": None, "two": a.select("f", "b").limit(3), "empty": a.limit(0), "text": a.select("e")}, rows


def _plain(values):
    found = [v for v in values if v is not None and v == v]
    q = {name: float(np.quantile(found, p)) for name, p in profiling.QUANTILES.items()}
    low, high = q["p25"] - 1.5 * (q["p75"] - q["p25"]), q["p75"] + 1.5 * (q["p75"] - q["p25"])
    out = sum(v < low or v > high for v in found) if q["p75"] > q["p25"] else 0
    return q | {"count": len(found), "outlier_iqr_count": out, "min": min(found), "max": max(found)}


@pytest.mark.parametrize("listed", [200_000, 3])
def test_profile_against_plain_code(spark, monkeypatch, listed):
    monkeypatch.setattr(profiling, "BRACKETED_VALUES", listed)
    tables, rows = _tables(spark)
    got = {(r["table"], r["column"]): r for r in profiling.profile_numeric(tables).collect()}
    assert set(got) == {("one", c) for c in "abcdf"} | {("two", c) for c in "fb"} | {("empty", c) for c in "abcdf"}
    for k, c in enumerate("abcdef"):
        if c in "de":
            continue
        for name, value in _plain([r[k] for r in rows]).items():
            assert got["one", c][name] == pytest.approx(value), (c, name)
    assert got["one", "d"]["count"] == 0 and got["one", "d"]["median"] is None and got["empty", "a"]["missing_pct"] == 1.0


def test_a_missed_bracket_is_widened(spark, monkeypatch):
    monkeypatch.setattr(Q, "SKETCH_SIZE", 8)
    monkeypatch.setattr(Q, "SKETCH_REACH", 1e-6)
    df = spark.range(5_000).selectExpr("cast(pmod(xxhash64(id), 100003) as double) AS v")
    values = [r["v"] for r in df.collect()]
    [got] = profiling.profile_numeric({"t": df}).collect()
    assert {n: got[n] for n in ("p01", "median", "p99", "outlier_iqr_count")} == {n: pytest.approx(v) for n, v in _plain(values).items() if n in ("p01", "median", "p99", "outlier_iqr_count")}


def test_columns_are_thinned_by_rank_in_pieces(spark, monkeypatch):
    """Every seventh value of each piece: moments stay whole, points stay near their ranks, the profile stays exact."""
    from duewise.operators import column_scans

    monkeypatch.setattr(column_scans, "PIECE_ROWS", 500)
    monkeypatch.setattr(profiling, "POINTS", 800)
    df = spark.range(0, 6_000, 1, 3).selectExpr(
        "IF(id % 10 = 0, NULL, cast(pmod(xxhash64(id), 1009) as double) - 100) AS v", "cast(id % 2 as int) AS w")
    values = sorted(r["v"] for r in df.collect() if r["v"] is not None)
    pieces = column_scans.ranked_points(df, {"v": df["v"]}, 7)
    points = sorted(p for r in pieces.collect() for p in r["points"])
    assert abs(len(points) - len(values) / 7) <= 3
    assert max(abs(np.searchsorted(values, p) / len(values) - k / len(points)) for k, p in enumerate(points)) < 0.02
    got = {r["column"]: r for r in profiling.profile_numeric({"t": df}).collect()}
    for name, value in _plain(values).items():
        assert got["v"][name] == pytest.approx(value), name
    assert got["v"]["mean"] == pytest.approx(np.mean(values)) and got["v"]["std"] == pytest.approx(np.std(values, ddof=1))
    assert got["v"]["zero_pct"] == pytest.approx(values.count(0.0) / len(values)) and got["w"]["median"] == 0.5
    assert got["v"]["negative_pct"] == pytest.approx(sum(v < 0 for v in values) / len(values)) and got["v"]["missing_pct"] == pytest.approx(0.1)

from __future__ import annotations

import math

import numpy as np
import pytest

from duewise.llm import whitening as w
from duewise.llm.shared import table

SCHEMA = "vec_id long, embedding array<float>, n long, component string"


@pytest.mark.parametrize("size", [1, 2, 7, 40])
@pytest.mark.parametrize("kind", ["random", "two values", "wide", "zero", "diagonal"])
def test_divide_and_conquer_gives_the_eigenvectors(size, kind):
    rng = np.random.default_rng(size)
    q, _ = np.linalg.qr(rng.normal(size=(size, size)))
    e = {"random": rng.random(size) * 50, "two values": np.r_[np.full(size // 2, 5.0), np.ones(size - size // 2)],
         "wide": 10.0 ** -np.linspace(0, 14, size), "zero": np.zeros(size), "diagonal": rng.random(size)}[kind]
    q = np.eye(size) if kind == "diagonal" else q
    v = (q * e) @ q.T
    v = (v + v.T) / 2
    values, vectors = w.divide_and_conquer(v)
    limit = 50 * np.finfo(float).eps
    assert np.abs(values - np.linalg.eigvalsh(v)[::-1]).max() <= limit * max(e.max(), 1e-300)
    assert np.abs(vectors.T @ vectors - np.eye(size)).max() <= limit
    assert np.abs(v @ vectors - vectors * values).max() <= limit * max(e.max(), 1e-300)


def test_polar_factor_is_the_sign():
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    e = np.r_[rng.random(5) + 1e-9, -rng.random(7) - 1e-9]
    assert np.abs(w.polar_factor((q * e) @ q.T) - (q * np.sign(e)) @ q.T).max() < 1e-8


def plain(rows):
    """Result by numpy's own eigenvectors and Python's whole numbers."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    lengths = [len(v) for _, v in good]
    d = max(set(lengths), key=lambda n: (lengths.count(n), n))
    good = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in good if len(v) == d]
    n, sums = len(good), [sum(v[k] for _, v in good) for k in range(d)]
    x = np.array([v for _, v in good], float) - np.array([s / n for s in sums])
    v = x.T @ x / n
    e, q = np.linalg.eigh(v)
    keep = [k for k in range(d - 1, -1, -1) if e[k] > d * np.finfo(float).eps * e[-1]][:32]
    white = x @ q[:, keep] / np.sqrt(e[keep])
    exact = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for _, row in good]
    return [i for i, _ in good], n, exact, white, e[keep] / np.trace(v)


def hold(spark, rows):
    ids, n, exact, white, shares = plain(rows)
    got = w.whiten(spark.createDataFrame([(i, v, 5, "x") for i, v in rows], SCHEMA)).collect()
    assert len(got) == len(ids) * len(shares)
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    by_row = sorted(zip(ids, exact, map(tuple, np.abs(white).round(6))))
    found: dict = {}
    for k, r in enumerate(got):
        found.setdefault(k // len(shares), []).append(r)
    rows_found = sorted((rs[0].vec_id, rs[0].deviation, tuple(abs(r.whitened) for r in rs)) for rs in found.values())
    for (i, dev, vector), (j, dev2, vector2) in zip(by_row, rows_found):
        assert (i, dev) == (j, dev2) and np.allclose(vector, vector2, atol=1e-5)
    for r in got:
        assert math.isclose(r.explained, shares[r.component - 1], rel_tol=1e-9)


def test_against_plain_version_with_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(200)]
    odd = [(900, None), (901, []), (902, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (903, [float("nan")] * 6), (904, [float("inf")] + [1.0] * 5),
           (905, [1.0, 2.0]), (7, rows[7][1]), (7, rows[3][1])]
    hold(spark, rows + odd)


def test_a_flat_dimension_has_no_component(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(a), float(b), 1.0, float(a)]) for i, (a, b) in enumerate(rng.normal(size=(60, 2)).astype(np.float32))]
    got = w.whiten(spark.createDataFrame([(i, v, 5, "x") for i, v in rows], SCHEMA))
    assert got.groupBy("vec_id").count().select("count").distinct().collect()[0][0] == 2


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]])
def test_nothing_to_whiten(spark, rows):
    assert w.whiten(spark.createDataFrame([(i, v, 5, "x") for i, v in rows], SCHEMA)).collect() == []


def test_huge_entries_stay_exact_or_null(spark):
    rows = [(1, [1e30, 0.0]), (2, [0.0, 1.0]), (3, [-1e30, 5.0])]
    got = w.whiten(spark.createDataFrame([(i, v, 5, "x") for i, v in rows], SCHEMA)).collect()
    assert {r.vec_id: r.deviation for r in got}[1] is None and all(math.isfinite(r.whitened) for r in got)


def test_given_table(spark, folder):
    got = w.whiten(table(spark, folder, "embeddings"))
    rows = [(r.vec_id, list(r.embedding)) for r in table(spark, folder, "embeddings").collect()]
    ids, n, exact, white, shares = plain(rows)
    assert got.count() == len(ids) * 32
    assert {r.vec_id: r.deviation for r in got.where("component = 1").collect()} == dict(zip(ids, exact))
    assert np.allclose(sorted({r.explained for r in got.select("explained").distinct().collect()}, reverse=True), shares, rtol=1e-9)

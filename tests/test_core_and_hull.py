import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from duewise.operators import allocation, hull
from duewise.operators.core import Branching, Core, flip_losses
from duewise.session import staged

SCHEMA = ("customer_id long, credit_id long, expected_net_value double, expected_recovery double, action_cost double, channel string")


def _best(value, uses, customer, room, limit):
    """The best value over all choices."""
    best = 0.0
    for mask in itertools.product((False, True), repeat=len(value)):
        x = np.array(mask)
        if (uses[x].sum(axis=0) <= limit + 1e-9).all() and (np.bincount(customer[x], minlength=len(room)) <= room).all():
            best = max(best, float(value[x].sum()))
    return best


@pytest.mark.parametrize("seed", range(40))
def test_branching_finds_and_proves_the_best_choice(seed):
    draw = np.random.default_rng(seed)
    n, d, k = int(draw.integers(1, 12)), int(draw.integers(1, 4)), int(draw.integers(1, 3))
    customer = draw.integers(0, max(1, n // 2), n)
    value, uses = draw.random(n) * 100 - 10, draw.random((n, d)) * 10
    limit, room = uses.sum(axis=0) * draw.random(d) * 0.6, np.full(customer.max() + 1, k)
    search = Branching(Core(np.arange(n), value, uses, customer, room, limit), np.zeros(d))
    search.run()
    best = _best(value, uses, customer, room, limit)
    assert search.value == pytest.approx(best, abs=1e-6)
    assert best - 1e-6 <= search.bound <= best + 1e-4


def test_a_search_cut_short_still_bounds():
    draw = np.random.default_rng(3)
    n = 16
    value, uses = draw.random(n) * 100, draw.random((n, 2)) * 10
    core = Core(np.arange(n), value, uses, np.arange(n), np.ones(n, int), np.array([17.0, 15.0]))
    search = Branching(core, np.zeros(2))
    search.run(most_nodes=1)
    assert search.value <= _best(value, uses, np.arange(n), np.ones(n, int), core.limit) + 1e-9 <= search.bound + 1e-6


@pytest.mark.parametrize("cap", [None, 1, 2])
def test_losses_are_what_the_bound_falls_by(spark, cap):
    draw = random.Random(4)
    rows = [(i, f"key {draw.randrange(5)}", draw.randrange(-20, 40) * 1.0) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, who string, r double")

    def priced(forced=None):
        """The priced value when one row is forced in or out."""
        total = 0.0
        for who in {w for _, w, _ in rows} if cap else [None]:
            mine = [(r, i) for i, w, r in rows if cap is None or w == who]
            inside = [r for r, i in mine if forced == (i, True)]
            free = sorted((r for r, i in mine if r > 0 and (forced is None or forced[0] != i)), reverse=True)
            total += sum(inside) + sum(free[: None if cap is None else cap - len(inside)])
        return total

    for r in flip_losses(df, F.col("r"), cap).collect():
        assert r["loss"] == pytest.approx(priced() - priced((r["id"], not r["taken"])))


@pytest.mark.parametrize("seed, limits", [
    (1, dict(budget=900.0)),
    (2, dict(budget=1200.0, capacity=3)),
    (3, dict(budget=5000.0, capacity=5, channel_limits={"llamada": 2, "automatico": 2}, per_customer=2)),
    (4, dict(budget=2000.0, channel_limits={"llamada": 1}, per_customer=None)),
])
def test_optimised_plan_is_proven_best(spark, seed, limits):
    draw = random.Random(seed)
    rows = [(i // 3, i, float(draw.randint(-50, 900)), 1.0, draw.choice((0.0, 150.0, 260.0, 1200.0, 333.3)), draw.choice(["llamada", "automatico", "manual"]))
            for i in range(13)]
    plan = allocation.plan_optimised(staged(spark.createDataFrame(rows, SCHEMA), "c"), gap=0.0, **limits)
    kept = [r for r in rows if r[2] >= 0]
    names = list(limits.get("channel_limits", {}))
    uses = np.array([[r[4], 1.0, *[float(r[5] == c) for c in names]] for r in kept])
    limit = np.array([limits["budget"], limits.get("capacity", 99), *[limits["channel_limits"][c] for c in names]], float)
    room = np.full(10, limits.get("per_customer", 1) or 99)
    best = _best(np.array([r[2] for r in kept]), uses, np.array([r[0] for r in kept]), room, limit)
    s = plan.summary
    assert s["expected_net_value"] == pytest.approx(best) and s["upper_bound"] == pytest.approx(best, rel=1e-6)
    chosen = plan.rows.collect()
    assert sum(r["action_cost"] for r in chosen) <= limits["budget"] + 1e-9
    assert "proven" in s["status"]


def test_a_small_core_of_many_open_rows_keeps_the_bound(spark, monkeypatch):
    monkeypatch.setattr(allocation, "CORE_ROWS", 5)
    draw = random.Random(8)
    rows = [(i, i, draw.uniform(5, 100), 1.0, round(draw.uniform(1, 50), 2), draw.choice(["llamada", "manual"])) for i in range(80)]
    df = staged(spark.createDataFrame(rows, SCHEMA), "c")
    limits = dict(budget=300.0, capacity=20, channel_limits={"llamada": 8})
    plan, greedy = allocation.plan_optimised(df, gap=0.0, **limits), allocation.plan_greedy(df, **limits)
    s = plan.summary
    assert greedy.summary["expected_net_value"] <= s["expected_net_value"] <= s["upper_bound"] + 1e-6
    assert s["cost_used"] <= 300.0 + 1e-6 and s["contacts"] <= 20 and s["contacts_by_channel"].get("llamada", 0) <= 8


def _plain_hull(points):
    """The upper hull from (0, 0): always on to the point of the steepest rise, the dearest of equal ones."""
    at, out = (0.0, 0.0), []
    best = {}
    for c, v in points:
        best[c] = max(v, best.get(c, 0.0))
    while True:
        rises = [((v - at[1]) / (c - at[0]) if c > at[0] else float("inf"), c, v) for c, v in best.items() if c >= at[0] and v > at[1] and (c, v) != at]
        if not rises:
            return out
        slope, c, v = max(rises)
        at = (c, v)
        out.append((c, v))


@pytest.mark.parametrize("pieces", [1, 3])
def test_hull_against_walk(spark, monkeypatch, pieces):
    monkeypatch.setattr(hull, "PIECES", pieces)
    draw = random.Random(6)
    rows = [(f"key {i % 9}", i, draw.choice((0.0, 1.0, 2.0, 3.0, 5.5, 8.0)), float(draw.randint(-5, 60))) for i in range(120)] + [("poor", 500, 1.0, -3.0)]
    df = spark.createDataFrame(rows, "who string, id long, action_cost double, expected_net_value double")
    got: dict = {}
    for r in hull.hull_steps(df).orderBy("who", "step").collect():
        got.setdefault(r["who"], []).append((r["cost"], r["value"]))
    for who in {r[0] for r in rows}:
        assert got.get(who, []) == _plain_hull([(c, v) for w, _, c, v in rows if w == who and v > 0])


def test_fractional_optimum_and_whole_steps(spark):
    draw = random.Random(7)
    rows = [(f"key {i // 4}", i, float(draw.randint(1, 30)), float(draw.randint(1, 90))) for i in range(40)]
    df = spark.createDataFrame(rows, "who string, id long, action_cost double, expected_net_value double")
    for budget in (0.0, 10.0, 47.0, 10_000.0):
        plan = hull.merge_steps(hull.hull_steps(df), budget)
        # The dual of the fractional problem, searched on a fine grid of prices, meets it.
        prices = [0.0] + [(v2 - v1) / (c2 - c1) for w in {r[0] for r in rows} for (c1, v1), (c2, v2) in itertools.combinations(
            [(0.0, 0.0)] + [(c, v) for x, _, c, v in rows if x == w], 2) if c2 != c1 and (v2 - v1) / (c2 - c1) > 0]
        dual = min(p * budget + sum(max([0.0] + [v - p * c for x, _, c, v in rows if x == w]) for w in {r[0] for r in rows}) for p in prices + [1e6])
        assert plan.bound == pytest.approx(dual)
        assert plan.bound - plan.step_value - 1e-9 <= plan.value <= plan.bound + 1e-9
        chosen = {r["id"] for r in plan.ids.collect()}
        assert sum(c for _, i, c, _ in rows if i in chosen) <= budget + 1e-9
        assert sum(v for _, i, _, v in rows if i in chosen) == pytest.approx(plan.value)


def test_assignment_is_proven_best_under_a_budget(spark):
    draw = random.Random(11)
    rows = [(c, c, float(draw.randint(1, 99)), 1.0, k, "manual") for c in range(4) for k in (1.0, 4.0, 9.0)]
    plan = allocation.plan_action_assignment(staged(spark.createDataFrame(rows, SCHEMA), "a"), budget=13.0, entity=["credit_id"], gap=0.0)
    value, cost, who = (np.array([r[k] for r in rows]) for k in (2, 4, 0))
    assert plan.summary["expected_net_value"] == pytest.approx(_best(value, cost[:, None], who, np.ones(4, int), np.array([13.0])))
    assert plan.summary["gap"] <= 1e-6

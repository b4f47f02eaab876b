import itertools
import random

import pytest

from duewise.operators import allocation
from duewise.session import staged

SCHEMA = ("customer_id long, credit_id long, expected_net_value double, expected_recovery double, action_cost double, channel string")


def _candidates(seed, n=120, costs=(0.0, 150.0, 250.0, 1200.0, 5000.0)):
    draw = random.Random(seed)
    return [
        (draw.randint(1, n // 3) if i % 3 else 1, i, float(draw.randint(-500, 20000)), float(draw.randint(0, 30000)),
         draw.choice(costs), draw.choice(["llamada", "automatico", " Manual "])) for i in range(n)
    ]


def _walk(rows, budget, capacity=None, channels=None, per_customer=1):
    """The sequential rule, row by row."""
    def roi(r):
        return r[2] / r[4] if r[4] > 0 else (float("inf") if r[2] > 0 else 0.0)

    rows = [(*r[:5], r[5].strip().lower()) for r in rows if r[2] >= 0]
    used, taken, by_channel, by_customer = 0.0, [], {}, {}
    for r in sorted(rows, key=lambda r: (-roi(r), -r[2], -r[3], r[0], r[1])):
        if used + r[4] > budget + 1e-9:
            continue
        if capacity is not None and len(taken) >= capacity:
            break
        if channels and r[5] in channels and by_channel.get(r[5], 0) >= channels[r[5]]:
            continue
        if per_customer is not None and by_customer.get(r[0], 0) >= per_customer:
            continue
        taken.append(r[1])
        used += r[4]
        by_channel[r[5]] = by_channel.get(r[5], 0) + 1
        by_customer[r[0]] = by_customer.get(r[0], 0) + 1
    return sorted(taken)


@pytest.mark.parametrize("seed, limits", [
    (1, dict(budget=20000.0)),
    (2, dict(budget=9000.0, capacity=12, channels={"llamada": 5}, per_customer=2)),
    (3, dict(budget=60000.0, channels={"llamada": 3, "automatico": 4}, per_customer=None)),
    (4, dict(budget=0.0)),
])
def test_greedy_rounds_equal_the_sequential_rule(spark, seed, limits):
    rows = _candidates(seed)
    df = staged(spark.createDataFrame(rows, SCHEMA), "c")
    plan = allocation.plan_greedy(df, limits["budget"], limits.get("capacity"), 0.0, limits.get("channels"), limits.get("per_customer", 1))
    assert sorted(r["credit_id"] for r in plan.rows.collect()) == _walk(rows, **limits)


def test_greedy_with_continuous_costs_and_fine_ranges(spark, monkeypatch):
    monkeypatch.setattr(allocation, "RANGES", 4)
    draw = random.Random(9)
    rows = [(i, i, draw.uniform(0, 100), 1.0, round(draw.uniform(1, 50), 2), "manual") for i in range(40)]
    plan = allocation.plan_greedy(staged(spark.createDataFrame(rows, SCHEMA), "c"), 300.0)
    assert sorted(r["credit_id"] for r in plan.rows.collect()) == _walk(rows, 300.0)


def test_optimised_is_feasible_and_close_to_brute_force(spark):
    rows = [(i // 2, i, float(v), float(v), c, "llamada") for i, (v, c) in enumerate(
        [(90, 5.0), (80, 4.0), (70, 3.0), (60, 6.0), (50, 2.0), (45, 2.0), (40, 1.0), (38, 4.0), (30, 3.0), (9, 1.0)])]
    df = staged(spark.createDataFrame(rows, SCHEMA), "c")
    plan = allocation.plan_optimised(df, budget=9.0, capacity=3)
    got = plan.rows.collect()
    assert sum(r["action_cost"] for r in got) <= 9.0 and len(got) <= 3
    assert len({r["customer_id"] for r in got}) == len(got)
    best = max(
        sum(r[2] for r in pick) for k in range(4) for pick in itertools.combinations(rows, k)
        if sum(r[4] for r in pick) <= 9.0 and len({r[0] for r in pick}) == len(pick))
    value = plan.summary["expected_net_value"]
    greedy = allocation.plan_greedy(df, budget=9.0, capacity=3).summary["expected_net_value"]
    assert greedy <= value <= best <= plan.summary["upper_bound"] + 1e-6
    assert plan.summary["gap"] == pytest.approx((plan.summary["upper_bound"] - value) / value)


def test_the_plan_is_the_same_for_any_partition_count_and_near_its_bound(spark):
    rows = _candidates(5, costs=(100.0, 900.0))
    plans = [
        allocation.plan_optimised(staged(spark.createDataFrame(rows, SCHEMA).repartition(n), "c"), budget=5000.0, per_customer=2)
        for n in (1, 7)
    ]
    ids = [sorted(r["credit_id"] for r in p.rows.collect()) for p in plans]
    assert ids[0] == ids[1]
    assert all(p.summary["expected_net_value"] <= p.summary["upper_bound"] + 1e-6 and p.summary["gap"] < 0.05 for p in plans)


def test_rows_without_a_customer_count_for_themselves(spark):
    rows = [(None, i, 50.0 - i, 60.0, 5.0, "manual") for i in range(6)] + [(1, 10 + i, 9.0 - i, 9.0, 5.0, "manual") for i in range(3)]
    df = staged(spark.createDataFrame(rows, SCHEMA), "c")
    for plan in (allocation.plan_greedy(df, 1000.0), allocation.plan_optimised(df, 1000.0)):
        assert sorted(r["credit_id"] for r in plan.rows.collect()) == [0, 1, 2, 3, 4, 5, 10]
    # Without the column every row is its own.
    assert allocation.plan_greedy(df.drop("customer_id"), 1000.0).summary["contacts"] == 9


def test_assignment_picks_one_action_per_entity(spark):
    rows = [(c, c, v, v, k, "manual") for c in range(6) for v, k in ((10.0, 1.0), (30.0, 4.0), (31.0, 9.0))]
    df = staged(spark.createDataFrame(rows, SCHEMA), "a")
    got = allocation.plan_action_assignment(df, budget=20.0, entity=["credit_id"]).rows.collect()
    assert len({r["credit_id"] for r in got}) == len(got) and sum(r["action_cost"] for r in got) <= 20.0


def test_empty_plan_and_summary_rebuild(spark):
    df = staged(spark.createDataFrame([(1, 1, -5.0, 1.0, 1.0, "manual")], SCHEMA), "e")
    plan = allocation.plan_greedy(df, 100.0)
    assert plan.summary["contacts"] == 0 and plan.summary["status"] == "empty_candidates"
    full = allocation.plan_greedy(staged(spark.createDataFrame(_candidates(1), SCHEMA), "c"), 20000.0)
    again = allocation.rebuild_summary(full.rows, 20000.0)
    assert again["cost_used"] == full.summary["cost_used"] and again["method"] == "greedy"
    assert allocation.summary_row(spark, full.summary).count() == 1


@pytest.mark.parametrize("bad", [dict(budget=-1), dict(budget=1, capacity=1.5), dict(budget=1, channel_limits={"x": -2})])
def test_limits_are_checked(bad):
    with pytest.raises(ValueError):
        allocation.check_limits(**bad)

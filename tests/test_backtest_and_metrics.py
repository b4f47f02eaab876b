import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from duewise.operators import backtest, metrics, profiling
from duewise.session import staged

COLUMNS = ("customer_id long, credit_id long, relative_due_day int, instalment_no int, amount_due double, days_past_due int, p_cure double, "
           "expected_recovery double, expected_net_value double, action_cost double, cured_in_horizon int, recovered_in_horizon double")


def _holdout(n=400):
    draw = random.Random(3)
    rows = [(i % 50, i, -i, i % 9, float(draw.randint(1, 5) * 100), draw.randint(0, 30), draw.randint(0, 10) / 10,
             float(draw.randint(0, 500)), float(draw.randint(-50, 500)), float(draw.choice([150, 250, 1200])),
             draw.randint(0, 1), float(draw.randint(0, 900))) for i in range(n)]
    return rows + [rows[7]] * (n // 2)  # copies of one row are a third of all


def test_random_draws_equal_brute_force(spark):
    rows = _holdout()
    out = {r["top_pct"]: r for r in backtest.random_benchmark(
        staged(spark.createDataFrame(rows, COLUMNS), "h"), simulations=20).collect()}
    for fraction in (0.05, 0.30):
        n = math.ceil(len(rows) * fraction)
        totals = []
        for sim in range(1, 21):
            def order(r):
                key = f"{r[1]}|{r[2]}|{r[3]}|{int(r[4] * 100)}|{int(r[11] * 100)}|{r[10] * 100}|{int(r[9] * 100)}"
                digest = hashlib.md5(key.encode()).hexdigest()
                x, y = (int(digest[i:i + 8], 16) % (2**31 - 1) for i in (0, 8))
                a, b = backtest.draw_factors(sim)
                return (x * a + y * b) % (2**31 - 1), key
            totals.append(sum(r[11] for r in sorted(rows, key=order)[:n]))
        assert out[fraction]["contacted"] == n
        assert out[fraction]["observed_recovery"] == pytest.approx(np.mean(totals))
        assert out[fraction]["random_recovery_p90"] == pytest.approx(np.percentile(totals, 90))


def test_curve_ends_at_everything_and_rises(spark):
    curve = backtest.recovery_curve(staged(spark.createDataFrame(_holdout(), COLUMNS), "h")).collect()
    assert len(curve) == 100 and curve[-1]["contacted"] == 600 and curve[-1]["capture"] == pytest.approx(1.0)
    assert all(a["cumulative_recovery"] <= b["cumulative_recovery"] for a, b in zip(curve, curve[1:]))


def test_curve_of_few_rows_has_every_percent(spark):
    curve = backtest.recovery_curve(staged(spark.createDataFrame(_holdout()[:7], COLUMNS), "h")).collect()
    assert [r["contacted"] for r in curve] == [max(1, -(-7 * p // 100)) for p in range(1, 101)]


def test_strategies_match_a_plain_sort(spark):
    rows = _holdout()
    out = backtest.strategy_benchmark(staged(spark.createDataFrame(rows, COLUMNS), "h"))
    got = {(r["strategy"], r["top_pct"]): r["observed_recovery"] for r in out.collect()}
    best = sorted(rows, key=lambda r: (-r[8], r[0], r[1], r[2], r[3], r[4]))[:60]
    assert got[("Mayor valor neto esperado", 0.10)] == sum(r[11] for r in best)


def test_metrics_with_ties_and_single_class(spark):
    rows = [(1, 0.9, 5.0), (0, 0.5, 1.0), (1, 0.5, 2.0), (0, 0.1, 0.0)]
    df = staged(spark.createDataFrame(rows, "label int, p double, amount double"), "m")
    assert metrics.auc_gini(df).first()["roc_auc"] == pytest.approx(0.875)
    assert metrics.average_precision(df).first()["average_precision"] == pytest.approx(0.5 * 1 + 0.5 * 2 / 3)
    one = staged(df.where(F.col("label") == 1), "one")
    assert metrics.auc_gini(one).first()["roc_auc"] is None
    none = staged(df.where(F.col("label") == 0), "none")
    assert metrics.average_precision(none).first()["average_precision"] is None


def test_profiles_of_odd_columns(spark):
    df = staged(spark.createDataFrame([(1, None, "a"), (1, None, None), (1, None, "a")], "customer_id long, empty double, word string"), "p")
    numeric = {r["column"]: r for r in profiling.profile_numeric({"t": df}).collect()}
    assert numeric["empty"]["count"] == 0 and numeric["empty"]["missing_pct"] == 1.0 and numeric["empty"]["mean"] is None
    assert numeric["customer_id"]["outlier_iqr_count"] == 0 and numeric["customer_id"]["std"] == 0.0
    table = profiling.profile_tables({"t": df, "gone": None}).orderBy("table").collect()
    assert [(r["table"], r["status"], r["duplicate_rows"]) for r in table] == [("gone", "missing", None), ("t", "ok", 1)]
    word = profiling.profile_categorical({"t": df}).first()
    assert (word["top_value"], word["top_freq"], word["example_values"]) == ("a", 2, "a")

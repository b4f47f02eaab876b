"""What shared stages write, and how often profiles are worked out."""

import datetime as dt

from pyspark.sql import functions as F

from duewise.operators import profiling
from duewise.queries import plan_queries, shared


def _given(spark, place):
    """Orders of three customers with a line every 30 days, some late and some short."""
    day = dt.date(1996, 1, 1)
    orders = [(k, k % 3 + 1) for k in range(6)]
    lines = [
        (k, 2 * n + k, n % 7 + 1, day + dt.timedelta(days=30 * n + k), "RAN"[(n + k) % 3], float(n % 20 + 1), 100.0 * n + k, 0.01 * ((n + k) % 11), 0.02)
        for k in range(6) for n in range(12)
    ]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{place}/orders.parquet")
    spark.createDataFrame(
        lines, "l_orderkey long, l_partkey long, l_linenumber int, l_shipdate date, l_returnflag string, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double").write.parquet(f"{place}/lineitem.parquet")
    return str(place)


def test_portfolio_is_written_without_unread_features(spark, tmp_path):
    rows = shared.portfolio(spark, _given(spark, tmp_path))
    assert rows.count() > 0
    assert not [c for c in rows.columns if c.startswith(("hist_", "roll", "last_"))]
    assert {"customer_id", "credit_id", "version", "pay_day", "payment", "action", "expected_net_value"} <= set(rows.columns)


def test_narrow_rows_are_those_of_the_wide_stage(spark, tmp_path):
    place = _given(spark, tmp_path)
    wide = shared.scored(spark, place).select(*shared.EVENT, *shared.OUTCOME)
    narrow = shared.scored(spark, place, shared.EVENT + shared.OUTCOME)
    assert narrow.count() > 0 and narrow.exceptAll(wide).count() == wide.exceptAll(narrow).count() == 0


def test_fractional_optimum_makes_one_portfolio(spark, tmp_path, monkeypatch):
    place, made = _given(spark, tmp_path), []
    found = shared.portfolio(spark, place)
    monkeypatch.setattr(plan_queries, "portfolio", lambda *_: made.append(1) or found)
    plan_queries.QUERIES["plan_action_lp"](spark, place).collect()
    assert len(made) == 1


def test_numbers_are_told_apart_by_64_bits(spark):
    rows = spark.createDataFrame(
        [(1, 0.0, "a"), (1, -0.0, "a"), (2, float("nan"), "b"), (None, None, None), (3, 0.5, "")], "n int, x double, t string")
    marks = profiling._marks(rows)
    assert marks.where("place < 2 AND second IS NOT NULL").count() == 0
    found = {r["column"]: (r["dtype"], r["missing_count"], r["non_missing_count"], r["unique_count"]) for r in profiling.profile_missing({"t": rows}).collect()}
    assert found == {"n": ("int", 1, 4, 3), "x": ("double", 2, 3, 2), "t": ("string", 1, 4, 3)}


def test_alerts_work_out_the_missing_profile_once(spark):
    rows = spark.range(4).select("id", F.lit(None).cast("double").alias("score"), F.lit("x").alias("kind"))
    events = rows.select(F.lit(1).alias("cured_in_horizon"), F.lit(1.0).alias("recovered_in_horizon"))
    alerts = profiling.quality_alerts(
        profiling.profile_missing({"t": rows}), profiling.profile_categorical({"t": rows}).limit(0), profiling.profile_numeric({"t": rows}),
        profiling.profile_targets(None, events), profiling.data_funnel({"application": rows}, events))
    assert {(r["kind"], r["column"]) for r in alerts.collect()} >= {("missingness", "score"), ("leakage_hint", "score")}
    assert "XXH64" not in alerts._jdf.queryExecution().optimizedPlan().toString().upper().replace("XXHASH64", "XXH64")

import pytest
from pyspark.sql import functions as F

from duewise import fixed_values as V
from duewise.functions.expressions import clip, infer_channel, safe_divide, safe_roi, status_number, tier
from duewise.operators import decision, policy
from duewise.session import staged


def _scored(spark, rows):
    return staged(spark.createDataFrame(rows, "customer_id long, credit_id long, p_cure double, amount_pred double, amount_due double"), "s")


def test_scalars(spark):
    row = spark.range(1).select(
        safe_divide(F.lit(1.0), F.lit(0.0), -1).alias("a"), safe_divide(F.lit(None).cast("double"), F.lit(2.0)).alias("b"),
        clip(F.lit(None).cast("int"), 0, 5).alias("c"), safe_roi(F.lit(3.0), F.lit(0.0)).alias("d"),
        safe_roi(F.lit(-3.0), F.lit(0.0)).alias("e"), status_number(F.lit("X")).alias("f"), status_number(F.lit("C")).alias("g"),
        infer_channel(F.lit("Contacto TELEFÓNICO por sms")).alias("h"), infer_channel(F.lit("otra cosa")).alias("i"),
        tier(F.lit(1.0), 2.0, 2.0, V.P_TIERS, "Media").alias("j"),
    ).first()
    assert tuple(row) == (-1.0, 0.0, None, float("inf"), 0.0, None, 0, "llamada", "manual", "Media")


def test_every_rule_and_cost(spark):
    rows = [(i, i, p, 90.0 * a, 100.0 * a) for i, (p, a) in enumerate(
        (p, a) for p in (0.05, 0.5, 0.9) for a in (1, 2, 3, 50, 90, 200))]
    out = decision.recommend_actions(_scored(spark, rows))
    costs = {r["action"]: r["action_cost"] for r in out.collect()}
    assert costs[V.ACTION_AUTO_MESSAGE] == 250 and costs[V.ACTION_SPECIALIST] == 5000 and costs[V.ACTION_DEFER] == 150
    assert costs[V.ACTION_PRIORITY_CALL] == 1200
    assert {r["priority"] for r in out.collect()} == {"Alta", "Media", "Baja"}


def test_capped_amount_and_bad_values(spark):
    out = decision.recommend_actions(_scored(spark, [(1, 1, 1.7, 500.0, 100.0), (2, 2, None, None, None)])).orderBy("credit_id").collect()
    assert out[0]["p_cure"] == 1.0 and out[0]["expected_recovery"] == 100.0
    assert out[1]["expected_recovery"] == 0.0 and out[1]["amount_due"] == 0.0


def test_negative_costs_are_refused(spark):
    with pytest.raises(ValueError, match="cost_call"):
        decision.recommend_actions(_scored(spark, [(1, 1, 0.5, 1.0, 1.0)]), cost_call=-1)


def test_reason_codes_default_and_limit(spark):
    rows = [(1, 100.0, 0.9, 0.9, 0.1, 1.0, 1.0), (2, 1.0, 0.1, 0.1, 1.0, 0.0, None)]
    df = spark.createDataFrame(rows, "credit_id long, amount_due double, hist_late_rate double, hist_partial_rate double, "
                                     "roll3_ratio_mean double, pos_dpd_max double, cc_dpd_max double")
    out = {r["credit_id"]: r["reason_codes"] for r in decision.add_reason_codes(staged(df, "r")).collect()}
    assert out[1] == "; ".join((V.REASON_AMOUNT, V.REASON_LATE, V.REASON_PARTIAL, V.REASON_RATIO))
    assert out[2] == V.REASON_DEFAULT


def test_policy():
    report = policy.apply_column_policy(["DAYS_BIRTH", "amount", "device_id_count"], ["EMAIL", "segment"])
    assert report.removed_explicit == ["DAYS_BIRTH"]
    assert report.removed_identifier_like == ["EMAIL", "device_id_count"]
    assert (report.kept_numeric, report.kept_categorical) == (["amount"], ["segment"])
    assert policy.apply_column_policy(["DAYS_BIRTH"], [], strict=False).kept_numeric == ["DAYS_BIRTH"]


def test_portfolio_keeps_one_row_per_credit_and_limits_before_the_shuffle(spark):
    rows = [(1, 1, float(v), v % 7) for v in range(50)] + [(1, 2, None, 1)]
    df = spark.createDataFrame(rows, "customer_id long, credit_id long, expected_net_value double, instalment_no int")
    out = decision.portfolio_latest(df)
    assert sorted((r["credit_id"], r["expected_net_value"]) for r in out.collect()) == [(1, 49.0), (2, None)]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()

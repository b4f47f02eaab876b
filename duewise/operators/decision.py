"""Actions, priorities, reason codes, review flags and the one-row-per-credit portfolio."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duewise import fixed_values as V
from duewise.functions.expressions import (
    cap_by_debt, clip, fill_zero, flag, require_columns, tier, to_number,
)
from duewise.operators.history import first_per_key
from duewise.operators.quantiles import exact_quantiles

_TIE_COLUMNS = (
    "customer_id", "credit_id", "relative_due_day", "instalment_no", "amount_due", "version", "pay_day", "payment",
)


def tie_breakers(df: DataFrame) -> list[Column]:
    """Columns that tell one event from another, as the tail of a total order."""
    return [F.col(c).asc_nulls_last() for c in _TIE_COLUMNS if c in df.columns]


def recommend_actions(
    df: DataFrame, cost_sms: float = 150, cost_whatsapp: float = 100, cost_call: float = 1200, cost_specialist: float = 5000
) -> DataFrame:
    """Costed action, expected net value, priority and tiers of every scored event.

    Thresholds are exact quantiles over the whole input: two passes give a handful of scalars, and
    the result itself is one projection without a shuffle. Give a scan or a staged table.
    """
    costs = {"cost_sms": cost_sms, "cost_whatsapp": cost_whatsapp, "cost_call": cost_call, "cost_specialist": cost_specialist}
    negative = {n: c for n, c in costs.items() if c < 0}
    if negative:
        raise ValueError(f"action costs must not be negative: {negative}")
    require_columns(df, ("p_cure", "amount_pred", "amount_due"), "actions")

    clean = df.withColumns({
        "amount_due": clip(fill_zero(to_number(F.col("amount_due"))), low=0.0),
        "p_cure": clip(fill_zero(to_number(F.col("p_cure"))), 0.0, 1.0),
        "amount_pred": clip(fill_zero(to_number(F.col("amount_pred"))), low=0.0),
    })
    clean = clean.withColumn("amount_pred_capped", cap_by_debt(F.col("amount_pred"), F.col("amount_due")))
    clean = clean.withColumn("expected_recovery", F.col("p_cure") * F.col("amount_pred_capped"))

    rows = df.count()
    cuts = exact_quantiles(
        clean,
        {"p": F.col("p_cure"), "amount": F.col("amount_due")},
        {"p": [0.30, 0.75], "amount": [0.33, 0.65, 0.66, 0.85]},
        rows=rows,
    )
    p_low, p_high = cuts["p"][0.30], cuts["p"][0.75]
    amount_high, amount_very_high = cuts["amount"][0.65], cuts["amount"][0.85]
    if p_low is None:  # no rows: nothing will be compared
        p_low, p_high, amount_high, amount_very_high = 0.40, 0.75, 0.0, 0.0

    p, amount = F.col("p_cure"), F.col("amount_due")
    likely, middling, unlikely = p >= p_high, (p >= p_low) & (p < p_high), p < p_low
    large = amount >= amount_high
    rules = [
        (likely & ~large, V.ACTION_AUTO_MESSAGE, cost_sms + cost_whatsapp),
        (likely & large, V.ACTION_PRIORITY_CALL, cost_call),
        (middling & large, V.ACTION_CALL_AGREEMENT, cost_call + cost_whatsapp),
        (middling & ~large, V.ACTION_AUTO_REMINDER, cost_sms),
        (unlikely & (amount >= amount_very_high), V.ACTION_SPECIALIST, cost_specialist),
        (unlikely & (amount < amount_very_high), V.ACTION_DEFER, cost_sms),
    ]
    action, cost = F, F
    for condition, label, price in rules:
        action = action.when(condition, F.lit(label))
        cost = cost.when(condition, F.lit(float(price)))
    decided = clean.withColumns({
        "action": action.otherwise(F.lit(V.ACTION_MANUAL)),
        "action_cost": cost.otherwise(F.lit(float(cost_call))),
        "baseline_recovery": _baseline(df.columns),
    })
    gain = F.col("expected_recovery") - F.col("baseline_recovery")
    decided = decided.withColumn("incremental_benefit", clip(gain, low=0.0))
    decided = decided.withColumn("expected_net_value", F.col("incremental_benefit") - F.col("action_cost"))

    net_cuts = exact_quantiles(
        decided, {"net": F.col("expected_net_value")}, {"net": [0.50, 0.80]}, rows=rows)["net"]
    q50, q80 = (net_cuts[0.50] or 0.0), (net_cuts[0.80] or 0.0)
    net = F.col("expected_net_value")
    return decided.withColumns({
        "priority": F.when(net >= q80, V.PRIORITY_HIGH).when(net >= q50, V.PRIORITY_MEDIUM).otherwise(V.PRIORITY_LOW),
        "p_tier": tier(p, cuts["p"][0.30], cuts["p"][0.75], V.P_TIERS, V.P_TIERS[1]),
        "amount_tier": tier(amount, cuts["amount"][0.33], cuts["amount"][0.66], V.AMOUNT_TIERS, V.AMOUNT_TIERS[1]),
    })


def _baseline(columns: list[str]) -> Column:
    """Recovery expected without any action: given, from a given probability, or none."""
    if "baseline_recovery" in columns:
        return cap_by_debt(clip(fill_zero(to_number(F.col("baseline_recovery"))), low=0.0), F.col("amount_due"))
    if "p_cure_untreated" in columns:
        return clip(fill_zero(to_number(F.col("p_cure_untreated"))), 0.0, 1.0) * F.col("amount_pred_capped")
    return F.lit(0.0)


def sort_ranked(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col("expected_net_value").desc_nulls_last(), *tie_breakers(df))


def add_reason_codes(df: DataFrame) -> DataFrame:
    """Up to four texts per row in a fixed order; columns that are absent give no reason."""
    high = exact_quantiles(df, {"a": F.col("amount_due")}, {"a": [0.75]})["a"][0.75]
    checks = [
        ("amount_due", lambda c: c >= F.lit(high), V.REASON_AMOUNT),
        ("hist_late_rate", lambda c: c >= 0.50, V.REASON_LATE),
        ("hist_partial_rate", lambda c: c >= 0.50, V.REASON_PARTIAL),
        ("roll3_ratio_mean", lambda c: c < 0.75, V.REASON_RATIO),
        ("bureau_credit_day_overdue_max", lambda c: c > 0, V.REASON_BUREAU),
        ("pos_dpd_max", lambda c: c > 0, V.REASON_POS),
        ("cc_dpd_max", lambda c: c > 0, V.REASON_CARD),
    ]
    found = F.array_compact(
        F.array(*[F.when(test(F.col(n)), F.lit(text)) for n, test, text in checks if n in df.columns])
    )
    text = F.when(F.size(found) > 0, F.concat_ws("; ", F.slice(found, 1, 4))).otherwise(F.lit(V.REASON_DEFAULT))
    return df.withColumn("reason_codes", text)


def add_human_review(df: DataFrame) -> DataFrame:
    def column(name: str) -> Column:
        return fill_zero(F.col(name)) if name in df.columns else F.lit(0.0)

    amount, p, net = column("amount_due"), column("p_cure"), column("expected_net_value")
    cut = exact_quantiles(df, {"a": amount}, {"a": [0.90]})["a"][0.90]
    special = F.col("action").rlike(V.REVIEW_ACTION_PATTERN) if "action" in df.columns else F.lit(False)
    review = (amount >= F.lit(cut)) | ((p >= 0.45) & (p <= 0.55)) | (net < 0) | F.coalesce(special, F.lit(False))
    return df.withColumn("needs_human_review", F.coalesce(review, F.lit(False)))


def portfolio_latest(df: DataFrame) -> DataFrame:
    """One row per customer and credit: the highest net value, then the highest instalment number."""
    if not {"customer_id", "credit_id"} <= set(df.columns):
        return df
    order = [F.col(c).desc_nulls_last() for c in ("expected_net_value", "instalment_no") if c in df.columns]
    return first_per_key(df, ["customer_id", "credit_id"], [*order, *tie_breakers(df)])


def project_outputs(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in V.OUTPUT_COLUMNS if c in df.columns])

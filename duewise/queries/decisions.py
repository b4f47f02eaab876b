"""Actions, reasons, review flags, portfolio and dashboard figures on the closed-form score."""

from __future__ import annotations

from pyspark.sql import functions as F

from duewise import fixed_values as V
from duewise.functions.expressions import cap_by_debt, infer_channel, safe_roi, tier
from duewise.operators import decision, views
from duewise.operators.quantiles import exact_quantiles
from duewise.queries.enrichments import ENRICHED_CTES
from duewise.queries.shared import (
    DECIDED, EVENT, PORTFOLIO, SCORED, decided_ctes, enriched, portfolio, scored, staged, tidy, tidy_sql, with_ctes,
)

_ACTION_COLUMNS = (
    "credit_id", "due_day", "number", "instalment", "p_cure", "amount_pred_capped", "expected_recovery", "baseline_recovery",
    "incremental_benefit", "action", "action_cost", "expected_net_value", "priority", "p_tier", "amount_tier",
)
_PORTFOLIO_COLUMNS = (
    "customer_id", "credit_id", "instalment_no", "relative_due_day", "amount_due", "p_cure", "expected_recovery", "action",
    "action_cost", "expected_net_value", "priority",
)
_KEY = ("credit_id", "due_day", "number", "instalment")
_PS = (0.10, 0.25, 0.50, 0.90)


def _decided(spark, folder, columns=EVENT):
    return decision.recommend_actions(scored(spark, folder, columns))


def _quantile_rows(spark, folder):
    df = scored(spark, folder, ("amount_due", "p_cure", "last_ratio", "roll3_unpaid_sum"))
    columns = {c: F.col(c) for c in ("amount_due", "p_cure", "last_ratio", "roll3_unpaid_sum")}
    found = exact_quantiles(df, columns, {c: list(_PS) for c in columns})
    rows = [(c, q, float(found[c][q])) for c in columns for q in _PS]
    return tidy(spark.createDataFrame(rows, "name string, q double, value double"), value=6)


def _bucket(spark, folder):
    df = scored(spark, folder, (*_KEY, "last_ratio"))
    cuts = exact_quantiles(df, {"r": F.col("last_ratio")}, {"r": [0.33, 0.66]})["r"]
    return df.select(*_KEY, tier(F.col("last_ratio"), cuts[0.33], cuts[0.66], V.AMOUNT_TIERS, "Medio").alias("bucket"))


def _channels(spark, folder):
    df = _decided(spark, folder)
    return df.groupBy("action", infer_channel(F.col("action")).alias("channel")).agg(F.count(F.lit(1)).alias("rows"))


def _roi(spark, folder):
    free = F.when(F.col("action") == V.ACTION_DEFER, F.lit(0.0)).otherwise(F.col("action_cost"))
    roi = safe_roi(F.col("expected_net_value"), free)
    return _decided(spark, folder).select(
        *_KEY, F.when(roi == float("inf"), F.lit(-1.0)).otherwise(roi).alias("roi"))


def _cap(spark, folder):
    return scored(spark, folder, EVENT).select(*_KEY, cap_by_debt(F.col("amount_pred") * 3, F.col("amount_due")).alias("capped"))


def _baseline(spark, folder):
    df = staged(scored(spark, folder, (*EVENT, "hist_full_rate")).withColumn("p_cure_untreated", F.col("hist_full_rate") * 0.25), "untreated")
    return decision.recommend_actions(df).select(*_KEY, "baseline_recovery", "incremental_benefit", "expected_net_value", "priority")


# What reasons are found in.
_REASON_COLUMNS = ("amount_due", "hist_late_rate", "hist_partial_rate", "roll3_ratio_mean", "bureau_credit_day_overdue_max", "pos_dpd_max", "cc_dpd_max")


def _reasons(spark, folder):
    return decision.add_reason_codes(enriched(spark, folder, _KEY + _REASON_COLUMNS)).select(*_KEY, "reason_codes")


def _review(spark, folder):
    return decision.add_human_review(staged(_decided(spark, folder), "decided")).select(*_KEY, "needs_human_review")


def _outputs(spark, folder):
    full = decision.add_human_review(decision.add_reason_codes(staged(_decided(spark, folder, None), "decided")))
    out = decision.project_outputs(decision.portfolio_latest(full))
    return tidy(out, recovered_in_horizon=6)


def _filtered(spark, folder):
    return views.portfolio_filter(
        portfolio(spark, folder), priorities=(V.PRIORITY_HIGH, V.PRIORITY_MEDIUM),
        actions=(V.ACTION_PRIORITY_CALL, V.ACTION_SPECIALIST, V.ACTION_AUTO_MESSAGE), min_p=0.2, min_amount=20000.0)


def _kpis(spark, folder):
    df = decision.add_human_review(portfolio(spark, folder))
    return tidy(views.portfolio_kpis(df), amount_due=2, expected_recovery=1, expected_net_value=1)


QUERIES = {
    "sort_ranked": lambda s, d: decision.sort_ranked(portfolio(s, d)).select(*_PORTFOLIO_COLUMNS),
    "exact_quantiles": _quantile_rows,
    "quantile_bucket": _bucket,
    "infer_channel": _channels,
    "safe_roi": _roi,
    "cap_by_debt": _cap,
    "recommend_actions": lambda s, d: _decided(s, d).select(*_ACTION_COLUMNS),
    "recommend_actions_baseline": _baseline,
    "reason_codes": _reasons,
    "human_review": _review,
    "portfolio_latest": lambda s, d: decision.portfolio_latest(_decided(s, d)).select(*_PORTFOLIO_COLUMNS),
    "project_outputs": _outputs,
    "portfolio_filter": lambda s, d: _filtered(s, d).select(*_PORTFOLIO_COLUMNS),
    "portfolio_kpis": _kpis,
    "value_counts": lambda s, d: views.value_counts(portfolio(s, d), "action"),
    "ranking_head": lambda s, d: views.ranking_head(portfolio(s, d), 300).select(*_PORTFOLIO_COLUMNS),
}

_REVIEW = """(amount_due >= (SELECT quantile_cont(amount_due, 0.9) FROM {t}) OR p_cure BETWEEN 0.45 AND 0.55
    OR expected_net_value < 0 OR regexp_matches(lower(action), 'descuento|especializada'))"""
_REASONS = """concat_ws('; ', CASE WHEN amount_due >= (SELECT quantile_cont(amount_due, 0.75) FROM {t}) THEN 'monto vencido alto' END,
    CASE WHEN hist_late_rate >= 0.5 THEN 'historial con alta frecuencia de atraso' END,
    CASE WHEN hist_partial_rate >= 0.5 THEN 'pagos parciales recurrentes' END,
    CASE WHEN roll3_ratio_mean < 0.75 THEN 'deterioro reciente en ratio de pago' END{more})"""
_BUREAU_REASONS = """,
    CASE WHEN bureau_credit_day_overdue_max > 0 THEN 'señal externa de atraso en bureau' END,
    CASE WHEN pos_dpd_max > 0 THEN 'atrasos históricos en POS/CASH' END,
    CASE WHEN cc_dpd_max > 0 THEN 'atrasos históricos en tarjeta' END"""


def _reason_sql(table: str, more: str = "") -> str:
    text = _REASONS.format(t=table, more=more)
    return (f"CASE WHEN {text} = '' THEN 'priorización por valor esperado neto' "
            f"ELSE array_to_string(string_split({text}, '; ')[1:4], '; ') END")


_OUT = """customer_id, credit_id, instalment_no, relative_due_day, amount_due, days_past_due, payment_ratio, unpaid_amount, p_cure,
    amount_pred, amount_pred_capped, expected_recovery, baseline_recovery, incremental_benefit, action_cost, expected_net_value,
    action, priority, needs_human_review, reason_codes, p_tier, amount_tier, cured_in_horizon, recovered_in_horizon, hist_count,
    hist_late_rate, hist_partial_rate, hist_dpd_mean, hist_dpd_max, roll3_late_rate, roll6_late_rate, last_dpd, last_ratio"""
_FULL = (
    f"{DECIDED}, full_events AS (SELECT *, {_REVIEW.format(t='decided')} AS needs_human_review, "
    f"{_reason_sql('decided')} AS reason_codes FROM decided)"
)
_PICK = """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, credit_id
    ORDER BY expected_net_value DESC, instalment_no DESC, relative_due_day, amount_due, version, pay_day NULLS LAST, payment) AS rn
    FROM full_events) WHERE rn = 1"""
_K = ", ".join(_KEY)
_P = ", ".join(_PORTFOLIO_COLUMNS)

CHECKS = {
    "sort_ranked": with_ctes(PORTFOLIO, f"SELECT {', '.join(_PORTFOLIO_COLUMNS)} FROM portfolio ORDER BY expected_net_value DESC"),
    "exact_quantiles": tidy_sql(with_ctes(SCORED, " UNION ALL ".join(
        f"SELECT '{c}' AS name, {q}::DOUBLE AS q, quantile_cont({c}, {q})::DOUBLE AS value FROM scored"
        for c in ("amount_due", "p_cure", "last_ratio", "roll3_unpaid_sum") for q in _PS)), value=6),
    "quantile_bucket": with_ctes(SCORED, f"""
        SELECT {_K}, CASE WHEN last_ratio <= (SELECT quantile_cont(last_ratio, 0.33) FROM scored) THEN 'Bajo'
                          WHEN last_ratio <= (SELECT quantile_cont(last_ratio, 0.66) FROM scored) THEN 'Medio'
                          WHEN last_ratio IS NOT NULL THEN 'Alto' ELSE 'Medio' END AS bucket FROM scored"""),
    "infer_channel": with_ctes(DECIDED, """
        SELECT action, CASE WHEN action LIKE '%descuento%' THEN 'especializada' WHEN action LIKE 'Llamada%' THEN 'llamada'
                            WHEN action LIKE 'Revisar%' THEN 'manual' ELSE 'automatico' END AS channel, count(*) AS rows
        FROM decided GROUP BY ALL"""),
    "safe_roi": with_ctes(DECIDED, f"""
        SELECT {_K}, CASE WHEN action <> 'Automatizar y postergar' THEN expected_net_value / action_cost
                          WHEN expected_net_value > 0 THEN -1.0 ELSE 0.0 END AS roi FROM decided"""),
    "cap_by_debt": with_ctes(SCORED, f"SELECT {_K}, least(amount_pred * 3, amount_due) AS capped FROM scored"),
    "recommend_actions": with_ctes(DECIDED, f"SELECT {', '.join(_ACTION_COLUMNS)} FROM decided"),
    "recommend_actions_baseline": with_ctes(
        f"{SCORED}, untreated AS (SELECT * FROM scored), "
        + decided_ctes("untreated").replace(
            "0.0::DOUBLE AS baseline_recovery", "hist_full_rate * 0.25::DOUBLE * amount_pred_capped AS baseline_recovery"),
        f"SELECT {_K}, baseline_recovery, incremental_benefit, expected_net_value, priority FROM decided"),
    "reason_codes": with_ctes(
        f"{SCORED}, {ENRICHED_CTES}, enriched AS (SELECT scored.*, bureau_credit_day_overdue_max, pos_dpd_max, cc_dpd_max "
        "FROM scored LEFT JOIN extra USING (customer_id))",
        f"SELECT {_K}, {_reason_sql('enriched', _BUREAU_REASONS)} AS reason_codes FROM enriched"),
    "human_review": with_ctes(DECIDED, f"SELECT {_K}, {_REVIEW.format(t='decided')} AS needs_human_review FROM decided"),
    "portfolio_latest": with_ctes(PORTFOLIO, f"SELECT {_P} FROM portfolio"),
    "project_outputs": tidy_sql(with_ctes(f"{_FULL}, p AS ({_PICK})", f"SELECT {_OUT} FROM p"), recovered_in_horizon=6),
    "portfolio_filter": with_ctes(PORTFOLIO, f"""
        SELECT {_P} FROM portfolio WHERE priority IN ('Alta', 'Media') AND p_cure >= 0.2 AND amount_due >= 20000
        AND action IN ('Llamada prioritaria', 'Oferta de descuento / gestión especializada', 'WhatsApp/SMS automático')"""),
    "portfolio_kpis": tidy_sql(with_ctes(PORTFOLIO, f"""
        SELECT count(*) AS rows, sum(amount_due) AS amount_due, sum(expected_recovery) AS expected_recovery,
               sum(action_cost) AS action_cost, sum(expected_net_value) AS expected_net_value,
               count(*) FILTER {_REVIEW.format(t='portfolio').replace('(amount', '(WHERE amount', 1)} AS human_reviews
        FROM portfolio"""), amount_due=2, expected_recovery=1, expected_net_value=1),
    "value_counts": with_ctes(PORTFOLIO, "SELECT action, count(*) AS rows FROM portfolio GROUP BY action"),
    "ranking_head": with_ctes(PORTFOLIO, f"""
        SELECT {_P} FROM portfolio ORDER BY expected_net_value DESC, customer_id, credit_id LIMIT 300"""),
}

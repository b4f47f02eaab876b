"""Model metrics of the closed-form score on labelled events."""

from __future__ import annotations

from pyspark.sql import functions as F

from duewise.functions.expressions import cap_by_debt
from duewise.operators import metrics, targets
from duewise.operators.modelling import group_split
from duewise.queries.shared import EVENT, OUTCOME, SCORED, scored, staged, tidy, tidy_sql, with_ctes

_TIES = ["credit_id", "due_day", "number", "instalment"]


def _inputs(spark, folder):
    """Label, probability and amount of labelled events; written because ranks read it twice."""
    capped = cap_by_debt(F.col("amount_pred"), F.col("amount_due"))
    return staged(targets.labelled_events(scored(spark, folder, EVENT + OUTCOME)).select(
        "customer_id", *_TIES, F.col("cured_in_horizon").alias("label"), F.col("p_cure").alias("p"),
        F.col("recovered_in_horizon").alias("amount"), capped.alias("amount_pred"), (F.col("p_cure") * capped).alias("expected"),
    ), "metric")


QUERIES = {
    "metric_auc_gini": lambda s, d: tidy(metrics.auc_gini(_inputs(s, d)), roc_auc=9, gini=9),
    "metric_average_precision": lambda s, d: tidy(
        metrics.average_precision(_inputs(s, d)), average_precision=9, base_rate=9, lift=9),
    "metric_brier": lambda s, d: tidy(metrics.brier(_inputs(s, d)), brier_score=9),
    "metric_capture": lambda s, d: tidy(metrics.capture(_inputs(s, d), _TIES), recovery_capture=9),
    "metric_topk_business": lambda s, d: metrics.topk_business(_inputs(s, d), _TIES),
    "metric_recovery_error": lambda s, d: tidy(
        metrics.recovery_error(_inputs(s, d)), expected_recovery_mae_all=4, expected_recovery_rmse_all=4,
        amount_mae_positive=4, amount_rmse_positive=4),
    "group_split": lambda s, d: group_split(_inputs(s, d).select("customer_id").distinct(), "customer_id"),
    "metric_split_profile": lambda s, d: tidy(metrics.split_profile(
        _inputs(s, d).join(group_split(_inputs(s, d), "customer_id"), "customer_id")), target_rate=9),
}

_IN = SCORED + """, m AS (
    SELECT customer_id, credit_id, due_day, number, instalment, cured_in_horizon AS label, p_cure AS p,
           recovered_in_horizon AS amount, least(amount_pred, amount_due) AS amount_pred,
           p_cure * least(amount_pred, amount_due) AS expected FROM scored WHERE cured_in_horizon IS NOT NULL)"""
_RANKED = _IN + """, r AS (SELECT *, row_number() OVER (ORDER BY p DESC, credit_id, due_day, number, instalment) AS k,
    count(*) OVER () AS n FROM m), f AS (SELECT unnest([0.05, 0.1, 0.2, 0.3])::DOUBLE AS top_pct)"""
_SPLIT = """
    SELECT customer_id, CASE WHEN k <= ntest THEN 'test' WHEN k <= ntest + ncal THEN 'calibration'
                             WHEN k <= ntest + ncal + nval THEN 'validation' ELSE 'train' END AS split
    FROM (SELECT customer_id, row_number() OVER (ORDER BY md5('42|' || customer_id), customer_id) AS k
          FROM (SELECT DISTINCT customer_id FROM m)),
         (SELECT *, ceil(0.15::DOUBLE * (n - ntest - ncal))::BIGINT AS nval FROM (
            SELECT *, ceil(0.2::DOUBLE * (n - ntest))::BIGINT AS ncal FROM (
                SELECT n, ceil(0.25::DOUBLE * n)::BIGINT AS ntest FROM (SELECT count(DISTINCT customer_id) AS n FROM m))))"""

CHECKS = {
    "metric_auc_gini": tidy_sql(with_ctes(_IN + """,
        k AS (SELECT label, avg(i) OVER (PARTITION BY p) AS mid FROM (SELECT *, row_number() OVER (ORDER BY p) AS i FROM m)),
        a AS (SELECT (sum(mid) FILTER (label = 1) - sum(label) * (sum(label) + 1) / 2.0)
                     / (sum(label) * (count(*) - sum(label)))::DOUBLE AS auc FROM k)""",
        "SELECT auc AS roc_auc, 2 * auc - 1 AS gini FROM a"), roc_auc=9, gini=9),
    "metric_average_precision": tidy_sql(with_ctes(_IN + """,
        s AS (SELECT p, count(*) AS n, sum(label) AS pos FROM m GROUP BY p),
        c AS (SELECT pos, sum(pos) OVER w AS tp, sum(n) OVER w AS k FROM s WINDOW w AS (ORDER BY p DESC)),
        a AS (SELECT sum(pos * (tp / k::DOUBLE)) / sum(pos)::DOUBLE AS ap FROM c)""", """
        SELECT ap AS average_precision, (SELECT avg(label) FROM m) AS base_rate, ap / (SELECT avg(label) FROM m) AS lift FROM a"""),
        average_precision=9, base_rate=9, lift=9),
    "metric_brier": tidy_sql(with_ctes(_IN, "SELECT avg((p - label) ** 2) AS brier_score FROM m"), brier_score=9),
    "metric_capture": tidy_sql(with_ctes(_RANKED, """
        SELECT top_pct, avg(label) AS target_rate, sum(amount) / (SELECT sum(amount) FROM m) AS recovery_capture
        FROM r JOIN f ON k <= greatest(1, floor(n * top_pct)) GROUP BY top_pct"""), recovery_capture=9),
    "metric_topk_business": with_ctes(_RANKED, """
        SELECT top_pct, avg(label) AS precision, sum(label)::DOUBLE / (SELECT sum(label) FROM m) AS recall, min(p) AS threshold
        FROM r JOIN f ON k <= greatest(1, ceil(n * top_pct)) GROUP BY top_pct"""),
    "metric_recovery_error": tidy_sql(with_ctes(_IN, """
        SELECT avg(abs(amount - expected)) AS expected_recovery_mae_all, sqrt(avg((amount - expected) ** 2)) AS expected_recovery_rmse_all,
               count(*) FILTER (amount > 0) AS n_positive_amount, avg(abs(amount - amount_pred)) FILTER (amount > 0) AS amount_mae_positive,
               sqrt(avg((amount - amount_pred) ** 2) FILTER (amount > 0)) AS amount_rmse_positive FROM m"""),
        expected_recovery_mae_all=4, expected_recovery_rmse_all=4, amount_mae_positive=4, amount_rmse_positive=4),
    "group_split": with_ctes(_IN, _SPLIT),
    "metric_split_profile": tidy_sql(with_ctes(f"{_IN}, s AS ({_SPLIT})", """
        SELECT split, count(*) AS rows, avg(label) AS target_rate, count(*) FILTER (label = 1 AND amount > 0) AS positive_amounts
        FROM m JOIN s USING (customer_id) GROUP BY split"""), target_rate=9),
}

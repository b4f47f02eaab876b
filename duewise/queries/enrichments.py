"""Customer features of the optional tables and their joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from duewise.functions.expressions import clip, flag, safe_divide, status_number
from duewise.operators import enrichment
from duewise.queries.shared import EV, credit_table, events, shape_ctes, tidy, tidy_sql, with_ctes

_BUREAU = {"bureau_credit_sum_total": 4, "bureau_credit_debt_total": 4, "bureau_credit_overdue_total": 4,
           "bureau_debt_to_credit_mean": 9}
_STATUS = {"bb_status_mean": 9, "bb_delinquent_rate_mean": 9}
_POS = {"pos_cnt_instalment_mean": 9, "pos_cnt_instalment_future_mean": 9}
_CARD = {c: 5 for c in ("cc_balance_mean", "cc_credit_limit_mean", "cc_drawings_mean", "cc_receivable_principal_mean")} | {
    "cc_payment_current_mean": 5, "cc_utilization_mean": 8, "cc_payment_to_balance_mean": 8}
_TABLES = ("bureau", "bureau_balance", "pos_cash", "credit_card")


def _load(spark, folder, *names):
    return {n: credit_table(spark, folder, n) for n in names}


def _status_map(spark, folder):
    return credit_table(spark, folder, "bureau_balance").groupBy("STATUS").agg(
        F.max(status_number(F.col("STATUS"))).alias("number"), F.count(F.lit(1)).alias("rows"))


def _full_outer(spark, folder):
    out = enrichment.optional_customer_features(_load(spark, folder, *_TABLES))
    return tidy(out.select("customer_id", "bureau_n_credits", "bb_status_max", "bb_months_total", "pos_records_count",
                           "pos_dpd_max", "cc_records_count", "cc_utilization_max", "cc_balance_mean"), cc_balance_mean=5)


def _join_enrichment(spark, folder):
    features = enrichment.optional_customer_features(_load(spark, folder, *_TABLES))
    return enrichment.join_enrichment(events(spark, folder), features).select(
        "credit_id", "due_day", "number", "instalment", "bureau_n_credits", "bb_status_max", "pos_dpd_max", "cc_dpd_max")


def _status_flags(spark, folder):
    return credit_table(spark, folder, "bureau").groupBy("CREDIT_ACTIVE").agg(
        F.sum(flag(F.col("CREDIT_ACTIVE") == "Active")).alias("active"), F.sum(flag(F.col("CREDIT_ACTIVE") == "Closed")).alias("closed"),
        F.sum(flag(F.col("AMT_CREDIT_SUM_OVERDUE") > 0)).alias("overdue"))


def _utilisation(spark, folder):
    card = credit_table(spark, folder, "credit_card")
    ratio = clip(safe_divide(F.col("AMT_BALANCE"), F.col("AMT_CREDIT_LIMIT_ACTUAL")), 0.0, 5.0)
    return card.select("credit_id", "MONTHS_BALANCE", "AMT_BALANCE", ratio.alias("utilisation"))


QUERIES = {
    "expr_status_flags": _status_flags,
    "expr_utilisation": _utilisation,
    "expr_status_map": _status_map,
    "bureau_features": lambda s, d: tidy(enrichment.bureau_features(credit_table(s, d, "bureau")), **_BUREAU),
    "bureau_status_features": lambda s, d: tidy(
        enrichment.bureau_status_features(credit_table(s, d, "bureau"), credit_table(s, d, "bureau_balance")), **_STATUS),
    "join_bureau_status": lambda s, d: tidy(
        enrichment.bureau_features(credit_table(s, d, "bureau"), credit_table(s, d, "bureau_balance")), **_BUREAU, **_STATUS),
    "pos_features": lambda s, d: tidy(enrichment.pos_features(credit_table(s, d, "pos_cash")), **_POS),
    "card_features": lambda s, d: tidy(enrichment.card_features(credit_table(s, d, "credit_card")), **_CARD),
    "join_optional_outer": _full_outer,
    "join_enrichment": _join_enrichment,
}

_BUREAU_SQL = """
    SELECT customer_id, count(DISTINCT bureau_id) AS bureau_n_credits,
           count(*) FILTER (CREDIT_ACTIVE = 'Active') AS bureau_active_count,
           count(*) FILTER (CREDIT_ACTIVE = 'Closed') AS bureau_closed_count,
           min(DAYS_CREDIT) AS bureau_days_credit_min, max(DAYS_CREDIT) AS bureau_days_credit_max,
           max(CREDIT_DAY_OVERDUE) AS bureau_credit_day_overdue_max,
           coalesce(sum(AMT_CREDIT_SUM), 0) AS bureau_credit_sum_total,
           coalesce(sum(AMT_CREDIT_SUM_DEBT), 0) AS bureau_credit_debt_total,
           coalesce(sum(AMT_CREDIT_SUM_OVERDUE), 0) AS bureau_credit_overdue_total,
           max(AMT_CREDIT_MAX_OVERDUE) AS bureau_max_overdue_max,
           avg(CASE WHEN AMT_CREDIT_SUM_DEBT IS NULL OR AMT_CREDIT_SUM = 0 THEN 0 ELSE AMT_CREDIT_SUM_DEBT / AMT_CREDIT_SUM END)
               AS bureau_debt_to_credit_mean,
           avg(CASE WHEN AMT_CREDIT_SUM_OVERDUE > 0 THEN 1 ELSE 0 END) AS bureau_has_overdue_rate
    FROM bureau GROUP BY customer_id"""
_STATUS_SQL = """
    SELECT customer_id, max(smax) AS bb_status_max, avg(smean) AS bb_status_mean, avg(rate) AS bb_delinquent_rate_mean,
           coalesce(sum(months), 0)::BIGINT AS bb_months_total
    FROM (SELECT DISTINCT customer_id, bureau_id FROM bureau) LEFT JOIN (
        SELECT bureau_id, count(MONTHS_BALANCE) AS months, max(n) AS smax, avg(n) AS smean,
               avg(CASE WHEN n > 0 THEN 1 ELSE 0 END) AS rate
        FROM (SELECT *, CASE STATUS WHEN 'C' THEN 0 WHEN 'X' THEN NULL ELSE STATUS::INT END AS n FROM bureau_balance)
        GROUP BY bureau_id) USING (bureau_id)
    GROUP BY customer_id"""
_POS_SQL = """
    SELECT customer_id, count(credit_id) AS pos_records_count, count(DISTINCT credit_id) AS pos_prev_count,
           min(MONTHS_BALANCE) AS pos_months_min, max(MONTHS_BALANCE) AS pos_months_max,
           avg(CNT_INSTALMENT) AS pos_cnt_instalment_mean, avg(CNT_INSTALMENT_FUTURE) AS pos_cnt_instalment_future_mean,
           avg(SK_DPD) AS pos_dpd_mean, max(SK_DPD) AS pos_dpd_max, avg(SK_DPD_DEF) AS pos_dpd_def_mean,
           max(SK_DPD_DEF) AS pos_dpd_def_max,
           avg(CASE WHEN NAME_CONTRACT_STATUS IN ('Active', 'Signed') THEN 1 ELSE 0 END) AS pos_active_rate
    FROM pos_cash GROUP BY customer_id"""
_CARD_SQL = """
    SELECT customer_id, count(credit_id) AS cc_records_count, count(DISTINCT credit_id) AS cc_prev_count,
           avg(AMT_BALANCE) AS cc_balance_mean, max(AMT_BALANCE) AS cc_balance_max,
           avg(AMT_CREDIT_LIMIT_ACTUAL) AS cc_credit_limit_mean, avg(AMT_DRAWINGS_CURRENT) AS cc_drawings_mean,
           avg(AMT_PAYMENT_CURRENT) AS cc_payment_current_mean, avg(AMT_RECEIVABLE_PRINCIPAL) AS cc_receivable_principal_mean,
           avg(u) AS cc_utilization_mean, max(u) AS cc_utilization_max, avg(b) AS cc_payment_to_balance_mean,
           avg(SK_DPD) AS cc_dpd_mean, max(SK_DPD) AS cc_dpd_max, avg(SK_DPD_DEF) AS cc_dpd_def_mean,
           max(SK_DPD_DEF) AS cc_dpd_def_max
    FROM (SELECT *, CASE WHEN AMT_CREDIT_LIMIT_ACTUAL = 0 THEN 0 ELSE least(AMT_BALANCE / AMT_CREDIT_LIMIT_ACTUAL, 5) END AS u,
                 CASE WHEN AMT_PAYMENT_CURRENT IS NULL OR AMT_BALANCE = 0 THEN 0
                      ELSE least(AMT_PAYMENT_CURRENT / AMT_BALANCE, 5) END AS b FROM credit_card)
    GROUP BY customer_id"""
ENRICHED_CTES = (
    shape_ctes(*_TABLES) + f", fb AS ({_BUREAU_SQL}), fs AS ({_STATUS_SQL}), fp AS ({_POS_SQL}), fc AS ({_CARD_SQL}), "
    "extra AS (SELECT * FROM fb LEFT JOIN fs USING (customer_id) FULL JOIN fp USING (customer_id) FULL JOIN fc USING (customer_id))"
)

CHECKS = {
    "expr_status_flags": with_ctes(shape_ctes("bureau"), """
        SELECT CREDIT_ACTIVE, count(*) FILTER (CREDIT_ACTIVE = 'Active') AS active, count(*) FILTER (CREDIT_ACTIVE = 'Closed') AS closed,
               count(*) FILTER (AMT_CREDIT_SUM_OVERDUE > 0) AS overdue FROM bureau GROUP BY CREDIT_ACTIVE"""),
    "expr_utilisation": with_ctes(shape_ctes("credit_card"), """
        SELECT credit_id, MONTHS_BALANCE, AMT_BALANCE, CASE WHEN AMT_CREDIT_LIMIT_ACTUAL = 0 THEN 0.0
               ELSE least(AMT_BALANCE / AMT_CREDIT_LIMIT_ACTUAL, 5.0) END AS utilisation FROM credit_card"""),
    "expr_status_map": with_ctes(shape_ctes("bureau_balance"), """
        SELECT STATUS, CASE STATUS WHEN 'C' THEN 0 WHEN 'X' THEN NULL ELSE STATUS::INT END AS number, count(*) AS rows
        FROM bureau_balance GROUP BY STATUS"""),
    "bureau_features": tidy_sql(with_ctes(shape_ctes("bureau"), _BUREAU_SQL), **_BUREAU),
    "bureau_status_features": tidy_sql(with_ctes(shape_ctes("bureau", "bureau_balance"), _STATUS_SQL), **_STATUS),
    "join_bureau_status": tidy_sql(with_ctes(
        shape_ctes("bureau", "bureau_balance") + f", fb AS ({_BUREAU_SQL}), fs AS ({_STATUS_SQL})",
        "SELECT * FROM fb LEFT JOIN fs USING (customer_id)"), **_BUREAU, **_STATUS),
    "pos_features": tidy_sql(with_ctes(shape_ctes("pos_cash"), _POS_SQL), **_POS),
    "card_features": tidy_sql(with_ctes(shape_ctes("credit_card"), _CARD_SQL), **_CARD),
    "join_optional_outer": tidy_sql(with_ctes(ENRICHED_CTES, """
        SELECT customer_id, bureau_n_credits, bb_status_max, bb_months_total, pos_records_count, pos_dpd_max,
               cc_records_count, cc_utilization_max, cc_balance_mean FROM extra"""), cc_balance_mean=5),
    "join_enrichment": with_ctes(f"{EV}, {ENRICHED_CTES}", """
        SELECT credit_id, due_day, number, instalment, bureau_n_credits, bb_status_max, pos_dpd_max, cc_dpd_max
        FROM ev LEFT JOIN extra USING (customer_id)"""),
}

"""Instalment facts, histories, events, targets and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from duewise.functions.expressions import amount_from_log, clip, entity_key, log_amount, prefix_columns, safe_divide, to_number
from duewise.operators import history, policy, targets
from duewise.queries.shared import (
    EV, HIST, HISTORY_DIGITS, PREP, TGT, credit_table, events, featured, shape_ctes, targets_sql, tidy, tidy_sql,
    with_ctes, with_targets,
)

_SNAPSHOT = (
    "credit_id", "customer_id", "due_day", "number", "instalment", "amount_due", "instalment_no", "relative_due_day",
    "hist_count", "hist_late_rate", "last_dpd", "roll3_dpd_max",
)
_TARGETS = (
    "credit_id", "due_day", "number", "instalment", "has_future_observation", "cured_in_horizon", "recovered_in_horizon",
)
_HISTORY = (
    "credit_id", "due_day", "number", "instalment", "hist_count", "hist_dpd_mean", "hist_dpd_max", "hist_dpd_std",
    "hist_late_rate", "hist_partial_rate", "hist_full_rate", "hist_ratio_mean", "hist_ratio_min", "hist_unpaid_sum",
    "hist_severity_sum", "hist_payment_sum", "hist_instalment_sum", "last_dpd", "last_ratio", "last_late", "last_partial",
    *[f"roll{k}_{n}" for k in (3, 6) for n in (
        "dpd_mean", "dpd_max", "late_rate", "partial_rate", "ratio_mean", "unpaid_sum", "severity_sum")],
)


def _safe_divide(spark, folder):
    card = credit_table(spark, folder, "credit_card")
    return card.select(
        "credit_id", "AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL",
        safe_divide(F.col("AMT_BALANCE"), F.col("AMT_CREDIT_LIMIT_ACTUAL"), -1.0).alias("balance_to_limit"),
        safe_divide(F.col("AMT_PAYMENT_CURRENT"), F.col("AMT_BALANCE")).alias("payment_to_balance"),
    )


def _clip(spark, folder):
    gap = F.col("pay_day") - F.col("due_day")
    return credit_table(spark, folder, "instalments").select(
        "credit_id", "due_day", "instalment",
        clip(gap, low=0).alias("not_negative"), clip(gap, 0, 10).alias("within"), clip(gap, high=-2).alias("at_most"),
    )


def _prefixed(spark, folder):
    pos = credit_table(spark, folder, "pos_cash").groupBy("customer_id").agg(
        F.max("SK_DPD").cast("long").alias("dpd"), F.count(F.lit(1)).alias("months"))
    return prefix_columns(pos, "pos_", ["customer_id"])


def _join_previous(spark, folder):
    out = history.join_previous(events(spark, folder), credit_table(spark, folder, "previous"))
    return out.select("credit_id", "due_day", "number", "instalment", "AMT_CREDIT", "NAME_CONTRACT_TYPE", "DAYS_DECISION",
                      "AMT_DOWN_PAYMENT")


def _join_application(spark, folder):
    out = history.collection_snapshots(
        credit_table(spark, folder, "instalments"), credit_table(spark, folder, "previous"),
        credit_table(spark, folder, "application"))
    return out.select("credit_id", "due_day", "number", "instalment", "AMT_CREDIT", "AMT_CREDIT_app", "AMT_ANNUITY",
                      "AMT_ANNUITY_app", "AMT_GOODS_PRICE_app", "TARGET", "ORGANIZATION_TYPE")


def _dedupe(spark, folder):
    return history.first_per_key(
        credit_table(spark, folder, "instalments").select("credit_id", "due_day", "number", "instalment"),
        ["credit_id"], history.instalment_order()[:2] + [F.col("instalment")])


def _all_instalment_targets(spark, folder):
    out = targets.forward_targets(featured(spark, folder), 60)
    return tidy(out.select(*_TARGETS), recovered_in_horizon=6)


def _feature_rows(spark, folder):
    """One row per candidate column of the event set with its kind."""
    data = history.join_application(
        history.join_previous(with_targets(spark, folder), credit_table(spark, folder, "previous")),
        credit_table(spark, folder, "application"))
    numeric, text = policy.feature_columns(data, scan=False)
    out = spark.createDataFrame(
        [(c, "numeric") for c in numeric] + [(c, "categorical") for c in text], "name string, kind string")
    return out


def _policy_rows(spark, folder):
    app = credit_table(spark, folder, "application").withColumn("phone_number", F.lit(1))
    numeric, text = policy.feature_columns(app)
    return policy.apply_column_policy(numeric + ["customer_id"], text).rows(spark)


def _to_number(spark, folder):
    """Text that may be no number: part of the event properties and the event type."""
    events_table = spark.read.parquet(f"{folder}/events.parquet")
    raw = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(F.col("value").cast("decimal(18,4)").cast("string"))
    return events_table.select("event_id", to_number(raw).alias("number"))


def _current_state(spark, folder):
    return events(spark, folder).groupBy("instalment_no").agg(
        F.count(F.lit(1)).alias("rows"), F.min("relative_due_day").alias("oldest"), F.max("amount_due").alias("largest"))


def _positive(spark, folder):
    rows = targets.labelled_events(with_targets(spark, folder)).where(
        (F.col("cured_in_horizon") == 1) & (F.col("recovered_in_horizon") > 0))
    return tidy(rows.select("credit_id", "due_day", "number", "instalment", log_amount(F.col("recovered_in_horizon")).alias("log_amount"),
                            amount_from_log(log_amount(F.col("recovered_in_horizon"))).alias("amount")), log_amount=9, amount=4)


def _without_empty(spark, folder):
    """Columns of the bureau table that stay, beside one that is null throughout."""
    data = credit_table(spark, folder, "bureau").withColumn("nothing", F.lit(None).cast("double"))
    numeric, text = policy.feature_columns(data)
    return data.groupBy("CREDIT_TYPE").agg(F.count(F.lit(1)).alias("rows")).select(
        "CREDIT_TYPE", "rows", F.lit(", ".join(sorted(numeric + text))).alias("kept"))


QUERIES = {
    "drop_all_null": _without_empty,
    "expr_to_number": _to_number,
    "event_current_state": _current_state,
    "expr_log_amount": _positive,
    "positive_amount_rows": lambda s, d: _positive(s, d).groupBy("number").agg(F.count(F.lit(1)).alias("rows")),
    "expr_safe_divide": _safe_divide,
    "expr_clip": _clip,
    "prefix_columns": _prefixed,
    "entity_key": lambda s, d: credit_table(s, d, "bureau").select(
        "bureau_id", entity_key(F.col("customer_id"), F.col("DAYS_ENDDATE_FACT").cast("int")).alias("entity")),
    "prepare_instalments": lambda s, d: history.prepare_instalments(credit_table(s, d, "instalments")),
    "history_features": lambda s, d: tidy(featured(s, d).select(*_HISTORY), **HISTORY_DIGITS),
    "delinquency_events": lambda s, d: events(s, d).select(*_SNAPSHOT),
    "dedupe_first": _dedupe,
    "forward_targets": lambda s, d: tidy(
        with_targets(s, d).select(*_TARGETS, "cured_in_horizon_60d", "recovered_in_horizon_60d"),
        recovered_in_horizon=6, recovered_in_horizon_60d=6),
    "forward_targets_180": lambda s, d: tidy(with_targets(s, d, 180).select(*_TARGETS), recovered_in_horizon=6),
    "forward_targets_all_instalments": _all_instalment_targets,
    "labelled_events": lambda s, d: targets.labelled_events(with_targets(s, d)).groupBy("cured_in_horizon").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("credit_id").alias("credits")),
    "join_previous": _join_previous,
    "join_application": _join_application,
    "feature_columns": _feature_rows,
    "column_policy": _policy_rows,
}

_PREVIOUS = f"{EV}, {shape_ctes('previous')}"
_BOTH = f"{_PREVIOUS}, {shape_ctes('application')}"
_JOINED = """SELECT e.*, p.* EXCLUDE (credit_id, customer_id), a.* EXCLUDE (customer_id) RENAME (
    AMT_CREDIT AS AMT_CREDIT_app, AMT_ANNUITY AS AMT_ANNUITY_app, AMT_GOODS_PRICE AS AMT_GOODS_PRICE_app)
    FROM {source} e LEFT JOIN previous p ON e.credit_id = p.credit_id AND e.customer_id = p.customer_id
    LEFT JOIN application a ON e.customer_id = a.customer_id"""
_NOT_FEATURES = ", ".join(f"'{c}'" for c in (
    "cured_in_horizon", "recovered_in_horizon", "cured_in_horizon_60d", "recovered_in_horizon_60d", "TARGET",
    "has_future_observation", "credit_id", "customer_id", "pay_day", "payment", "days_before_due", "overpay_amount"))

_PAID = "FROM tgt WHERE cured_in_horizon = 1 AND recovered_in_horizon > 0"
CHECKS = {
    "drop_all_null": with_ctes(shape_ctes("bureau"), """
        SELECT CREDIT_TYPE, count(*) AS rows, (
            SELECT string_agg(column_name, ', ' ORDER BY column_name) FROM (SUMMARIZE SELECT * FROM bureau)
            WHERE null_percentage < 100 AND (column_type <> 'VARCHAR' OR approx_unique <= 80)
              AND column_name NOT IN ('customer_id', 'credit_id')) AS kept
        FROM bureau GROUP BY CREDIT_TYPE"""),
    "expr_to_number": """
        SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN value::DECIMAL(18, 4)::DOUBLE END AS number FROM events""",
    "event_current_state": with_ctes(EV, """
        SELECT number AS instalment_no, count(*) AS rows, min(due_day) AS oldest, max(instalment) AS largest FROM ev GROUP BY number"""),
    "expr_log_amount": tidy_sql(with_ctes(TGT, f"""
        SELECT credit_id, due_day, number, instalment, ln(1 + recovered_in_horizon) AS log_amount, recovered_in_horizon AS amount {_PAID}"""),
        log_amount=9, amount=4),
    "positive_amount_rows": with_ctes(TGT, f"SELECT number, count(*) AS rows {_PAID} GROUP BY number"),
    "expr_safe_divide": with_ctes(shape_ctes("credit_card"), """
        SELECT credit_id, AMT_BALANCE, AMT_CREDIT_LIMIT_ACTUAL,
               CASE WHEN AMT_CREDIT_LIMIT_ACTUAL = 0 THEN -1.0 ELSE AMT_BALANCE / AMT_CREDIT_LIMIT_ACTUAL END AS balance_to_limit,
               CASE WHEN AMT_BALANCE = 0 OR AMT_PAYMENT_CURRENT IS NULL THEN 0.0
                    ELSE AMT_PAYMENT_CURRENT / AMT_BALANCE END AS payment_to_balance FROM credit_card"""),
    "expr_clip": with_ctes(shape_ctes("instalments"), """
        SELECT credit_id, due_day, instalment,
               CASE WHEN pay_day IS NOT NULL THEN greatest(pay_day - due_day, 0) END AS not_negative,
               CASE WHEN pay_day IS NOT NULL THEN least(greatest(pay_day - due_day, 0), 10) END AS within,
               CASE WHEN pay_day IS NOT NULL THEN least(pay_day - due_day, -2) END AS at_most FROM instalments"""),
    "prefix_columns": with_ctes(shape_ctes("pos_cash"), """
        SELECT customer_id, max(SK_DPD)::BIGINT AS pos_dpd, count(*) AS pos_months FROM pos_cash GROUP BY customer_id"""),
    "entity_key": with_ctes(shape_ctes("bureau"), """
        SELECT bureau_id, customer_id::VARCHAR || '|' || coalesce(DAYS_ENDDATE_FACT::INT::VARCHAR, 'null') AS entity FROM bureau"""),
    "prepare_instalments": with_ctes(PREP, "SELECT * FROM prep"),
    "history_features": tidy_sql(with_ctes(HIST, f"SELECT {', '.join(_HISTORY)} FROM hist"), **HISTORY_DIGITS),
    "delinquency_events": with_ctes(EV, f"SELECT {', '.join(_SNAPSHOT)} FROM ev"),
    "dedupe_first": with_ctes(shape_ctes("instalments"), """
        SELECT credit_id, due_day, number, instalment FROM instalments
        QUALIFY row_number() OVER (PARTITION BY credit_id ORDER BY due_day, number, instalment) = 1"""),
    "forward_targets": tidy_sql(with_ctes(
        TGT, f"SELECT {', '.join(_TARGETS)}, cured_in_horizon_60d, recovered_in_horizon_60d FROM tgt"),
        recovered_in_horizon=6, recovered_in_horizon_60d=6),
    "forward_targets_180": tidy_sql(
        with_ctes(f"{EV}, t AS ({targets_sql('ev', 180)})", f"SELECT {', '.join(_TARGETS)} FROM t"), recovered_in_horizon=6),
    "forward_targets_all_instalments": tidy_sql(
        with_ctes(f"{HIST}, t AS ({targets_sql('hist', 60)})", f"SELECT {', '.join(_TARGETS)} FROM t"), recovered_in_horizon=6),
    "labelled_events": with_ctes(TGT, """
        SELECT cured_in_horizon, count(*) AS rows, count(DISTINCT credit_id) AS credits FROM tgt
        WHERE cured_in_horizon IS NOT NULL AND recovered_in_horizon IS NOT NULL GROUP BY cured_in_horizon"""),
    "join_previous": with_ctes(_PREVIOUS, """
        SELECT e.credit_id, due_day, number, instalment, AMT_CREDIT, NAME_CONTRACT_TYPE, DAYS_DECISION, AMT_DOWN_PAYMENT
        FROM ev e LEFT JOIN previous p ON e.credit_id = p.credit_id AND e.customer_id = p.customer_id"""),
    "join_application": with_ctes(f"{_BOTH}, j AS ({_JOINED.format(source='ev')})", """
        SELECT credit_id, due_day, number, instalment, AMT_CREDIT, AMT_CREDIT_app, AMT_ANNUITY, AMT_ANNUITY_app,
               AMT_GOODS_PRICE_app, TARGET, ORGANIZATION_TYPE FROM j"""),
    "feature_columns": with_ctes(
        f"{TGT}, {shape_ctes('previous', 'application')}, j AS ({_JOINED.format(source='tgt')})", f"""
        SELECT column_name AS name, CASE WHEN column_type = 'VARCHAR' THEN 'categorical' ELSE 'numeric' END AS kind
        FROM (SUMMARIZE SELECT * FROM j)
        WHERE null_percentage < 100 AND (column_type <> 'VARCHAR' OR approx_unique <= 80)
          AND column_name NOT IN ({_NOT_FEATURES})"""),
    "column_policy": with_ctes(shape_ctes("application") + """,
        c AS (SELECT column_name AS name, column_type FROM (DESCRIBE SELECT *, 1 AS phone_number FROM application)
              WHERE column_name NOT IN ('TARGET', 'EXT_SOURCE_3'))""", """
        SELECT name AS column,
               CASE WHEN name IN ('CODE_GENDER', 'DAYS_BIRTH', 'CNT_CHILDREN', 'CNT_FAM_MEMBERS', 'NAME_FAMILY_STATUS',
                                  'customer_id', 'phone_number') THEN 'removed' ELSE 'kept' END AS status,
               CASE WHEN name IN ('CODE_GENDER', 'DAYS_BIRTH', 'CNT_CHILDREN', 'CNT_FAM_MEMBERS', 'NAME_FAMILY_STATUS',
                                  'customer_id') THEN 'explicit'
                    WHEN name = 'phone_number' THEN 'identifier_like'
                    WHEN column_type = 'VARCHAR' THEN 'categorical' ELSE 'numeric' END AS rule
        FROM c"""),
}

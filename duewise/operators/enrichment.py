"""Customer features from the optional bureau, POS and card tables.

All are group-bys that add up within each task before the shuffle, so a customer with a large share
of the rows costs no more than another.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duewise import fixed_values as V
from duewise.functions.expressions import clip, flag, safe_divide, status_number, sum_or_zero, to_number


_TEXTS = ("CREDIT_ACTIVE", "NAME_CONTRACT_STATUS")


def _with_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Absent columns as nulls, so that a narrow source still aggregates; numbers kept as text are read."""
    kinds = dict(df.dtypes)
    absent = {n: F.lit(None).cast("double") for n in names if n not in kinds}
    texts = {n: to_number(F.col(n)) for n in names if kinds.get(n) == "string" and n not in _TEXTS}
    return df.withColumns({**absent, **texts}) if absent or texts else df


def bureau_status_features(bureau: DataFrame, balance: DataFrame) -> DataFrame:
    """Monthly status per bureau credit, then per customer over distinct (customer, credit) links."""
    number = status_number(F.col("STATUS"))
    per_credit = balance.groupBy("bureau_id").agg(
        F.count("MONTHS_BALANCE").alias("months"),
        F.max(number).alias("status_max"),
        F.avg(number).alias("status_mean"),
        F.avg(flag(number > 0)).alias("delinquent_rate"),
    )
    links = bureau.select("customer_id", "bureau_id").distinct()
    return links.join(per_credit, "bureau_id", "left").groupBy("customer_id").agg(
        F.max("status_max").alias("bb_status_max"),
        F.avg("status_mean").alias("bb_status_mean"),
        F.avg("delinquent_rate").alias("bb_delinquent_rate_mean"),
        F.coalesce(F.sum("months"), F.lit(0)).alias("bb_months_total"),
    )


def bureau_features(bureau: DataFrame, balance: DataFrame | None = None) -> DataFrame:
    b = _with_columns(
        bureau,
        ["CREDIT_ACTIVE", "DAYS_CREDIT", "CREDIT_DAY_OVERDUE", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT",
         "AMT_CREDIT_SUM_OVERDUE", "AMT_CREDIT_MAX_OVERDUE"],
    )
    out = b.groupBy("customer_id").agg(
        F.countDistinct("bureau_id").alias("bureau_n_credits"),
        F.sum(flag(F.col("CREDIT_ACTIVE") == "Active")).alias("bureau_active_count"),
        F.sum(flag(F.col("CREDIT_ACTIVE") == "Closed")).alias("bureau_closed_count"),
        F.min("DAYS_CREDIT").alias("bureau_days_credit_min"),
        F.max("DAYS_CREDIT").alias("bureau_days_credit_max"),
        F.max("CREDIT_DAY_OVERDUE").alias("bureau_credit_day_overdue_max"),
        sum_or_zero(F.col("AMT_CREDIT_SUM")).alias("bureau_credit_sum_total"),
        sum_or_zero(F.col("AMT_CREDIT_SUM_DEBT")).alias("bureau_credit_debt_total"),
        sum_or_zero(F.col("AMT_CREDIT_SUM_OVERDUE")).alias("bureau_credit_overdue_total"),
        F.max("AMT_CREDIT_MAX_OVERDUE").alias("bureau_max_overdue_max"),
        F.avg(safe_divide(F.col("AMT_CREDIT_SUM_DEBT"), F.col("AMT_CREDIT_SUM"))).alias("bureau_debt_to_credit_mean"),
        F.avg(flag(F.col("AMT_CREDIT_SUM_OVERDUE") > 0)).alias("bureau_has_overdue_rate"),
    )
    if balance is not None and {"bureau_id", "STATUS"} <= set(balance.columns):
        out = out.join(bureau_status_features(bureau, balance), "customer_id", "left")
    return out


def pos_features(pos: DataFrame) -> DataFrame:
    p = _with_columns(
        pos,
        ["MONTHS_BALANCE", "CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE", "SK_DPD", "SK_DPD_DEF", "NAME_CONTRACT_STATUS"],
    )
    return p.groupBy("customer_id").agg(
        F.count("credit_id").alias("pos_records_count"),
        F.countDistinct("credit_id").alias("pos_prev_count"),
        F.min("MONTHS_BALANCE").alias("pos_months_min"),
        F.max("MONTHS_BALANCE").alias("pos_months_max"),
        F.avg("CNT_INSTALMENT").alias("pos_cnt_instalment_mean"),
        F.avg("CNT_INSTALMENT_FUTURE").alias("pos_cnt_instalment_future_mean"),
        F.avg("SK_DPD").alias("pos_dpd_mean"),
        F.max("SK_DPD").alias("pos_dpd_max"),
        F.avg("SK_DPD_DEF").alias("pos_dpd_def_mean"),
        F.max("SK_DPD_DEF").alias("pos_dpd_def_max"),
        F.avg(flag(F.col("NAME_CONTRACT_STATUS").isin("Active", "Signed"))).alias("pos_active_rate"),
    )


def card_features(card: DataFrame) -> DataFrame:
    c = _with_columns(
        card,
        ["AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL", "AMT_DRAWINGS_CURRENT", "AMT_PAYMENT_CURRENT",
         "AMT_RECEIVABLE_PRINCIPAL", "SK_DPD", "SK_DPD_DEF"],
    )
    utilisation = clip(safe_divide(F.col("AMT_BALANCE"), F.col("AMT_CREDIT_LIMIT_ACTUAL")), 0.0, V.MAX_RATIO)
    paid = clip(safe_divide(F.col("AMT_PAYMENT_CURRENT"), F.col("AMT_BALANCE")), 0.0, V.MAX_RATIO)
    return c.groupBy("customer_id").agg(
        F.count("credit_id").alias("cc_records_count"),
        F.countDistinct("credit_id").alias("cc_prev_count"),
        F.avg("AMT_BALANCE").alias("cc_balance_mean"),
        F.max("AMT_BALANCE").alias("cc_balance_max"),
        F.avg("AMT_CREDIT_LIMIT_ACTUAL").alias("cc_credit_limit_mean"),
        F.avg("AMT_DRAWINGS_CURRENT").alias("cc_drawings_mean"),
        F.avg("AMT_PAYMENT_CURRENT").alias("cc_payment_current_mean"),
        F.avg("AMT_RECEIVABLE_PRINCIPAL").alias("cc_receivable_principal_mean"),
        F.avg(utilisation).alias("cc_utilization_mean"),
        F.max(utilisation).alias("cc_utilization_max"),
        F.avg(paid).alias("cc_payment_to_balance_mean"),
        F.avg("SK_DPD").alias("cc_dpd_mean"),
        F.max("SK_DPD").alias("cc_dpd_max"),
        F.avg("SK_DPD_DEF").alias("cc_dpd_def_mean"),
        F.max("SK_DPD_DEF").alias("cc_dpd_def_max"),
    )


def optional_parts(tables: dict[str, DataFrame | None]) -> list[DataFrame]:
    """The features of each optional table that is there, one row per customer each."""
    parts = []
    if tables.get("bureau") is not None:
        parts.append(bureau_features(tables["bureau"], tables.get("bureau_balance")))
    if tables.get("pos_cash") is not None:
        parts.append(pos_features(tables["pos_cash"]))
    if tables.get("credit_card") is not None:
        parts.append(card_features(tables["credit_card"]))
    return parts


def optional_customer_features(tables: dict[str, DataFrame | None]) -> DataFrame | None:
    """One row per customer known to any optional table; None when there is none.

    The key of a full join may come from either side, so each further part is dealt out again. To
    enrich events, ``join_parts`` needs no such table.
    """
    parts = optional_parts(tables)
    return reduce(lambda a, b: a.join(b, "customer_id", "full"), parts) if parts else None


def join_enrichment(events: DataFrame, features: DataFrame | None) -> DataFrame:
    return events if features is None else events.join(features, "customer_id", "left")


def join_parts(events: DataFrame, parts: list[DataFrame]) -> DataFrame:
    """Events with every part: one shuffle of the events by customer serves all of the joins."""
    return reduce(lambda a, b: a.join(b, "customer_id", "left"), parts, events)

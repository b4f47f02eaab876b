"""Stages that queries share, once as DataFrames and once as SQL for the checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duewise.functions.expressions import ROUNDING_CUT, rounded
from duewise.operators import decision, enrichment, history, targets
from duewise.session import staged
from duewise.sources.fixtures import SHAPES, check_sql, credit_table, credit_tables

HORIZON = 60


def tidy(df: DataFrame, **digits: int) -> DataFrame:
    """Round sums whose last digits depend on the order of adding."""
    return df.withColumns({c: rounded(F.col(c), d) for c, d in digits.items()})


def tidy_sql(sql: str, **digits: int) -> str:
    body = ", ".join(f'floor({c} * 1e{d} + {ROUNDING_CUT}::DOUBLE) / 1e{d} AS {c}' for c, d in digits.items())
    return f"SELECT * REPLACE ({body}) FROM ({sql})" if body else sql


HISTORY_DIGITS = {
    "hist_ratio_mean": 9, "hist_unpaid_sum": 6, "hist_severity_sum": 6, "hist_payment_sum": 6,
    "hist_instalment_sum": 6, "roll3_ratio_mean": 9, "roll6_ratio_mean": 9, "roll3_unpaid_sum": 6,
    "roll6_unpaid_sum": 6, "roll3_severity_sum": 6, "roll6_severity_sum": 6,
}


# --- DataFrame stages ---

def featured(spark: SparkSession, folder: str) -> DataFrame:
    return history.history_features(history.prepare_instalments(credit_table(spark, folder, "instalments")))


def events(spark: SparkSession, folder: str) -> DataFrame:
    return history.delinquency_events(featured(spark, folder))


def with_targets(spark: SparkSession, folder: str, horizon: int = HORIZON) -> DataFrame:
    prepared = history.prepare_instalments(credit_table(spark, folder, "instalments"))
    hot = history.hot_keys(prepared, "credit_id")
    found = history.delinquency_events(history.history_features(prepared, hot))
    return targets.forward_targets(found, horizon, hot)


def scorecard(df: DataFrame) -> DataFrame:
    """A closed-form score from history rates, so that decisions can be checked without a model."""
    p = 0.85 - 0.45 * F.col("hist_late_rate") - 0.25 * F.col("hist_partial_rate") + 0.05 * F.col("is_full")
    amount = F.col("instalment") * (0.30 + 0.65 * F.col("hist_full_rate"))
    return df.withColumns({"p_cure": p, "amount_pred": amount})


# What decisions, portfolios and plans know of an event besides its score; the order of ties included.
EVENT = ("customer_id", "credit_id", "version", "number", "due_day", "pay_day", "instalment", "payment",
         "instalment_no", "relative_due_day", "amount_due", "p_cure", "amount_pred")
OUTCOME = ("days_past_due", "cured_in_horizon", "recovered_in_horizon")


def scored(spark: SparkSession, folder: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Scored events with targets, written once because decisions read them several times.

    Give the ``columns`` that are read later: what is written can no longer be pruned.
    """
    found = scorecard(with_targets(spark, folder))
    return staged(found.select(*columns) if columns else found, "scored")


def enriched_events(spark: SparkSession, folder: str) -> DataFrame:
    """Scored events with the customer features of the optional tables, not written yet."""
    tables = {t: credit_table(spark, folder, t) for t in ("bureau", "bureau_balance", "pos_cash", "credit_card")}
    parts = enrichment.optional_parts(tables)
    return enrichment.join_parts(scorecard(with_targets(spark, folder)), parts)


def enriched(spark: SparkSession, folder: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    """The same written once; as for ``scored``, give the ``columns`` that are read later."""
    found = enriched_events(spark, folder)
    return staged(found.select(*columns) if columns else found, "enriched")


def holdout(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled events with decisions of their own, the input of back-tests."""
    return staged(decision.recommend_actions(targets.labelled_events(scored(spark, folder, EVENT + OUTCOME))), "holdout")


def portfolio(spark: SparkSession, folder: str) -> DataFrame:
    return staged(decision.portfolio_latest(decision.recommend_actions(scored(spark, folder, EVENT))), "portfolio")


# --- the same stages in SQL, written independently ---

_PREP = """
    SELECT *,
           CASE WHEN pay_day > due_day THEN pay_day - due_day WHEN pay_day IS NOT NULL THEN 0 END AS days_past_due,
           CASE WHEN due_day > pay_day THEN due_day - pay_day WHEN pay_day IS NOT NULL THEN 0 END AS days_before_due,
           CASE WHEN instalment = 0 THEN 0.0 WHEN payment / instalment > 5 THEN 5.0
                WHEN payment / instalment < 0 THEN 0.0 ELSE payment / instalment END AS payment_ratio,
           CASE WHEN instalment > payment THEN instalment - payment ELSE 0.0 END AS unpaid_amount,
           CASE WHEN payment > instalment THEN payment - instalment ELSE 0.0 END AS overpay_amount
    FROM inst"""
_PREP2 = """
    SELECT *, CASE WHEN days_past_due > 0 THEN 1 ELSE 0 END AS is_late,
           CASE WHEN payment_ratio < 0.98 THEN 1 ELSE 0 END AS is_partial,
           CASE WHEN payment_ratio >= 0.98 THEN 1 ELSE 0 END AS is_full,
           coalesce(days_past_due, 0) * instalment AS severity
    FROM prep1"""
_ORDER = "due_day NULLS LAST, number NULLS LAST, version, pay_day NULLS LAST, instalment, payment"


def _hist() -> str:
    def run(value: str, fn: str = "sum") -> str:
        return f"{fn}({value}) OVER past"

    cols = [
        "row_number() OVER w - 1 AS hist_count",
        f"CASE WHEN row_number() OVER w > 1 THEN {run('coalesce(days_past_due, 0)')} / (row_number() OVER w - 1.0)::DOUBLE END AS hist_dpd_mean",
        f"CASE WHEN lag(days_past_due) OVER w IS NOT NULL THEN {run('days_past_due', 'max')} END AS hist_dpd_max",
        f"CASE WHEN row_number() OVER w > 1 THEN {run('coalesce(days_past_due, 0) * coalesce(days_past_due, 0)')} / (row_number() OVER w - 1.0)::DOUBLE END AS dpd_sq_mean",
    ]
    for name, col in (("late", "is_late"), ("partial", "is_partial"), ("full", "is_full")):
        cols.append(f"CASE WHEN row_number() OVER w > 1 THEN {run(col)} / (row_number() OVER w - 1.0)::DOUBLE END AS hist_{name}_rate")
    cols.append(f"CASE WHEN row_number() OVER w > 1 THEN {run('payment_ratio')} / (row_number() OVER w - 1.0)::DOUBLE END AS hist_ratio_mean")
    cols.append(f"CASE WHEN lag(payment_ratio) OVER w IS NOT NULL THEN {run('payment_ratio', 'min')} END AS hist_ratio_min")
    for name, col in (("unpaid", "unpaid_amount"), ("severity", "severity"), ("payment", "payment"), ("instalment", "instalment")):
        cols.append(f"coalesce({run(col)}, 0.0) AS hist_{name}_sum")
    for name, col in (("last_dpd", "days_past_due"), ("last_ratio", "payment_ratio"), ("last_late", "is_late"), ("last_partial", "is_partial")):
        cols.append(f"lag({col}) OVER w AS {name}")
    for k in (3, 6):
        for name, fn, col in (
            ("dpd_mean", "avg", "days_past_due"), ("dpd_max", "max", "days_past_due"), ("late_rate", "avg", "is_late"),
            ("partial_rate", "avg", "is_partial"), ("ratio_mean", "avg", "payment_ratio"),
            ("unpaid_sum", "sum", "unpaid_amount"), ("severity_sum", "sum", "severity"),
        ):
            cols.append(f"{fn}({col}) OVER r{k} AS roll{k}_{name}")
    by = f"PARTITION BY credit_id ORDER BY {_ORDER}"
    return (
        f"SELECT *, {', '.join(cols)} FROM prep WINDOW w AS ({by}), "
        f"past AS ({by} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), "
        f"r3 AS ({by} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), r6 AS ({by} ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)"
    )


_HIST2 = """
    SELECT * EXCLUDE (dpd_sq_mean), CASE WHEN dpd_sq_mean - hist_dpd_mean * hist_dpd_mean < 0 THEN 0.0
                ELSE sqrt(dpd_sq_mean - hist_dpd_mean * hist_dpd_mean) END AS hist_dpd_std
    FROM hist1"""
_EV = """
    SELECT *, instalment AS amount_due, coalesce(number, 0) AS instalment_no, coalesce(due_day, 0) AS relative_due_day
    FROM hist WHERE (is_late = 1 OR is_partial = 1) AND hist_count >= 2"""


def targets_sql(source: str, horizon: int) -> str:
    def ahead(c: str, k: int) -> str:
        return f"lead({c}, {k}) OVER w"

    def inside(k: int) -> str:
        return f"coalesce({ahead('due_day', k)} - due_day > 0 AND {ahead('due_day', k)} - due_day <= {horizon}, false)"

    paid = " + ".join(
        f"CASE WHEN {inside(k)} THEN CASE WHEN {ahead('payment', k)} < {ahead('instalment', k)} THEN {ahead('payment', k)} "
        f"ELSE {ahead('instalment', k)} END ELSE 0.0 END" for k in (1, 2, 3)
    )
    seen = " OR ".join(f"({inside(k)})" for k in (1, 2, 3))
    good = " OR ".join(
        f"({inside(k)} AND {ahead('payment_ratio', k)} >= 0.98 AND coalesce({ahead('days_past_due', k)}, 999) <= 15)"
        for k in (1, 2, 3)
    )
    return (
        f"SELECT *, CASE WHEN {seen} THEN 1 ELSE 0 END AS has_future_observation, "
        f"CASE WHEN {seen} THEN CASE WHEN {good} THEN 1 ELSE 0 END END AS cured_in_horizon, "
        f"CASE WHEN {seen} THEN {paid} END AS recovered_in_horizon "
        f"FROM {source} WINDOW w AS (PARTITION BY credit_id ORDER BY {_ORDER})"
    )


def shape_ctes(*shapes: str) -> str:
    return ", ".join(f"{s} AS ({check_sql(s)})" for s in (shapes or SHAPES))


PREP = f"inst AS ({check_sql('instalments')}), prep1 AS ({_PREP}), prep AS ({_PREP2})"
HIST = f"{PREP}, hist1 AS ({_hist()}), hist AS ({_HIST2})"
EV = f"{HIST}, ev AS ({_EV})"
_ALIASES = "SELECT *, cured_in_horizon AS cured_in_horizon_60d, recovered_in_horizon AS recovered_in_horizon_60d FROM tgt0"
TGT = f"{EV}, tgt0 AS ({targets_sql('ev', HORIZON)}), tgt AS ({_ALIASES})"
SCORED = TGT + """, scored AS (
    SELECT *, 0.85::DOUBLE - 0.45::DOUBLE * hist_late_rate - 0.25::DOUBLE * hist_partial_rate + 0.05::DOUBLE * is_full AS p_cure,
           instalment * (0.30::DOUBLE + 0.65::DOUBLE * hist_full_rate) AS amount_pred
    FROM tgt)"""


def decided_ctes(source: str, name: str = "decided") -> str:
    """CTEs that turn scored rows of ``source`` into ``name`` with action, cost, value and priority."""
    return f"""
    {name}_a AS (
        SELECT * REPLACE (greatest(least(coalesce(p_cure, 0), 1), 0) AS p_cure,
                          greatest(coalesce(amount_pred, 0), 0) AS amount_pred,
                          greatest(coalesce(amount_due, 0), 0) AS amount_due),
               least(greatest(coalesce(amount_pred, 0), 0), greatest(coalesce(amount_due, 0), 0)) AS amount_pred_capped
        FROM {source}),
    {name}_q AS (
        SELECT quantile_cont(p_cure, 0.30) AS p30, quantile_cont(p_cure, 0.75) AS p75,
               quantile_cont(amount_due, 0.33) AS a33, quantile_cont(amount_due, 0.65) AS a65,
               quantile_cont(amount_due, 0.66) AS a66, quantile_cont(amount_due, 0.85) AS a85 FROM {name}_a),
    {name}_b AS (
        SELECT x.*, p_cure * amount_pred_capped AS expected_recovery,
               CASE WHEN p_cure >= p75 AND amount_due < a65 THEN 'WhatsApp/SMS automático'
                    WHEN p_cure >= p75 THEN 'Llamada prioritaria'
                    WHEN p_cure >= p30 AND amount_due >= a65 THEN 'Llamada + propuesta de convenio'
                    WHEN p_cure >= p30 THEN 'Recordatorio automático y monitoreo'
                    WHEN amount_due >= a85 THEN 'Oferta de descuento / gestión especializada'
                    ELSE 'Automatizar y postergar' END AS action,
               0.0::DOUBLE AS baseline_recovery,
               CASE WHEN p_cure <= p30 THEN 'Baja' WHEN p_cure <= p75 THEN 'Media' ELSE 'Alta' END AS p_tier,
               CASE WHEN amount_due <= a33 THEN 'Bajo' WHEN amount_due <= a66 THEN 'Medio' ELSE 'Alto' END AS amount_tier
        FROM {name}_a x, {name}_q),
    {name}_c AS (
        SELECT *, CASE action WHEN 'WhatsApp/SMS automático' THEN 250.0 WHEN 'Llamada prioritaria' THEN 1200.0
                   WHEN 'Llamada + propuesta de convenio' THEN 1300.0 WHEN 'Recordatorio automático y monitoreo' THEN 150.0
                   WHEN 'Oferta de descuento / gestión especializada' THEN 5000.0 ELSE 150.0 END::DOUBLE AS action_cost,
               greatest(expected_recovery - baseline_recovery, 0) AS incremental_benefit FROM {name}_b),
    {name}_d AS (SELECT *, incremental_benefit - action_cost AS expected_net_value FROM {name}_c),
    {name}_n AS (SELECT quantile_cont(expected_net_value, 0.5) AS n50, quantile_cont(expected_net_value, 0.8) AS n80 FROM {name}_d),
    {name} AS (SELECT x.*, CASE WHEN expected_net_value >= n80 THEN 'Alta' WHEN expected_net_value >= n50 THEN 'Media'
                      ELSE 'Baja' END AS priority FROM {name}_d x, {name}_n)"""


_PORTFOLIO = """
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_id, credit_id ORDER BY expected_net_value DESC,
               instalment_no DESC, relative_due_day, amount_due, version, pay_day NULLS LAST, payment) AS rn FROM decided)
    WHERE rn = 1"""
DECIDED = f"{SCORED}, {decided_ctes('scored')}"
PORTFOLIO = f"{DECIDED}, portfolio AS ({_PORTFOLIO})"
HOLDOUT = f"{SCORED}, labelled AS (SELECT * FROM scored WHERE cured_in_horizon IS NOT NULL), {decided_ctes('labelled', 'holdout')}"


def with_ctes(ctes: str, body: str) -> str:
    return f"WITH {ctes} {body}"


__all__ = [n for n in dir() if not n.startswith("_")]

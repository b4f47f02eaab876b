"""Economic back-test on labelled events with decisions of their own."""

from __future__ import annotations

from duewise import fixed_values as V
from duewise.operators import backtest
from duewise.queries.shared import HOLDOUT, holdout, tidy, tidy_sql, with_ctes

_DIGITS = {"observed_recovery": 1, "observed_net": 1, "capture": 9}
_RANDOM = {"success_rate": 9, "lift": 9, "observed_recovery": 1, "capture": 9, "cost": 3, "observed_net": 1,
           "random_recovery_p10": 1, "random_recovery_p90": 1, "random_net_p10": 1, "random_net_p90": 1}
_COMPARED = {"success_rate": 9, "observed_recovery": 1, "model_gain": 9, "lift_vs_random": 9}
_COMPARE_COLUMNS = ("strategy", "strategy_kind", "top_pct", "contacted", "success_rate", "observed_recovery", "model_gain",
                    "lift_vs_random", "beats_random_p90")
_ROW = ("customer_id", "credit_id", "relative_due_day", "instalment_no")
_SLICE = ("strategy", "strategy_kind", "top_pct", "contacted", "observed_recovery")



def _both(spark, folder):
    """The two back-tests over the same rows."""
    rows = holdout(spark, folder)
    return backtest.benchmark_compare(backtest.strategy_benchmark(rows), backtest.random_benchmark(rows))


QUERIES = {
    "strategy_benchmark": lambda s, d: tidy(backtest.strategy_benchmark(holdout(s, d)), base_rate=9, lift=9, **_DIGITS),
    "random_benchmark": lambda s, d: tidy(backtest.random_benchmark(holdout(s, d)), base_rate=9, **_RANDOM),
    "benchmark_compare": lambda s, d: tidy(backtest.full_benchmark(holdout(s, d)).select(*_COMPARE_COLUMNS), **_COMPARED),
    "benchmark_slice": lambda s, d: tidy(
        backtest.benchmark_slice(backtest.strategy_benchmark(holdout(s, d)), 0.10).select(*_SLICE), observed_recovery=1),
    "recovery_curve": lambda s, d: tidy(
        backtest.recovery_curve(holdout(s, d)), cumulative_recovery=1, capture=9, observed_net=1),
    "recovery_curve_steps": lambda s, d: tidy(
        backtest.recovery_curve(holdout(s, d), V.STRATEGY_AMOUNT, 0.05), cumulative_recovery=1, capture=9, observed_net=1),
    "top_fraction": lambda s, d: backtest.top_fraction(holdout(s, d), 0.10).select(*_ROW, "expected_net_value", "position"),
    "union_benchmark": lambda s, d: _both(s, d).select("strategy", "strategy_kind", "top_pct", "contacted"),
    "join_benchmark_refs": lambda s, d: tidy(
        backtest.full_benchmark(holdout(s, d)).select("strategy", "top_pct", "model_gain", "lift_vs_random"), model_gain=9, lift_vs_random=9),
}

_CTES = HOLDOUT + """,
    h AS (SELECT *, greatest(coalesce(recovered_in_horizon, 0), 0) AS rec, coalesce(cured_in_horizon, 0) AS ok,
                 credit_id || '|' || relative_due_day || '|' || instalment_no || '|' || floor(amount_due * 100 + 0.5)::BIGINT || '|'
                 || floor(recovered_in_horizon * 100 + 0.5)::BIGINT || '|' || (cured_in_horizon * 100)::BIGINT || '|'
                 || floor(action_cost * 100 + 0.5)::BIGINT AS key FROM holdout),
    tot AS (SELECT count(*) AS n, sum(rec) AS total, avg(ok) AS base FROM h),
    f AS (SELECT unnest([0.05, 0.1, 0.2, 0.3])::DOUBLE AS top_pct),
    sizes AS (SELECT top_pct, greatest(1, ceil(n * top_pct))::BIGINT AS contacted, n, total, base FROM f, tot),
    st AS (
        SELECT 'Mayor monto vencido' AS strategy, amount_due AS score, * FROM h
        UNION ALL SELECT 'Mayor DPD', coalesce(days_past_due, 0), * FROM h
        UNION ALL SELECT 'Mayor prob. regularización', p_cure, * FROM h
        UNION ALL SELECT 'Mayor recuperación esperada', expected_recovery, * FROM h
        UNION ALL SELECT 'Mayor valor neto esperado', expected_net_value, * FROM h),
    rk AS (SELECT strategy, rec, ok, action_cost, row_number() OVER (PARTITION BY strategy ORDER BY score DESC, customer_id, credit_id,
                  relative_due_day, instalment_no, amount_due) AS k FROM st),
    det AS (
        SELECT strategy, 'deterministica' AS strategy_kind, top_pct, contacted, avg(ok) AS success_rate, any_value(base) AS base_rate,
               avg(ok) / any_value(base) AS lift, sum(rec) AS observed_recovery, sum(rec) / any_value(total) AS capture,
               sum(action_cost) AS cost, sum(rec) - sum(action_cost) AS observed_net
        FROM rk JOIN sizes ON k <= contacted GROUP BY strategy, top_pct, contacted)"""
_SIMS = _CTES + """,
    hx AS (SELECT rec, ok, action_cost, key, ('0x' || substr(md5(key), 1, 8))::BIGINT % 2147483647 AS x,
                  ('0x' || substr(md5(key), 9, 8))::BIGINT % 2147483647 AS y FROM h),
    fx AS (SELECT sim, ('0x' || substr(md5('a' || sim), 1, 8))::BIGINT % 2147483647 AS a,
                  ('0x' || substr(md5('b' || sim), 1, 8))::BIGINT % 2147483647 AS b FROM (SELECT unnest(range(1, 201)) AS sim)),
    dr AS (SELECT sim, rec, ok, action_cost, row_number() OVER (PARTITION BY sim ORDER BY (x * a + y * b) % 2147483647, key) AS k
           FROM hx, fx),
    per AS (SELECT sim, top_pct, contacted, sum(rec) AS rec, sum(action_cost) AS cost, avg(ok) AS rate,
                   any_value(base) AS base, any_value(total) AS total FROM dr JOIN sizes ON k <= contacted GROUP BY sim, top_pct, contacted),
    rnd AS (
        SELECT 'Aleatorio promedio (200 sims)' AS strategy, 'aleatoria_simulada' AS strategy_kind, top_pct, contacted,
               avg(rate) AS success_rate, any_value(base) AS base_rate, avg(rate) / any_value(base) AS lift,
               avg(rec) AS observed_recovery, avg(rec) / any_value(total) AS capture, avg(cost) AS cost, avg(rec - cost) AS observed_net,
               quantile_cont(rec, 0.1) AS random_recovery_p10, quantile_cont(rec, 0.9) AS random_recovery_p90,
               quantile_cont(rec - cost, 0.1) AS random_net_p10, quantile_cont(rec - cost, 0.9) AS random_net_p90
        FROM per GROUP BY top_pct, contacted)"""



def _curve_sql(strategy: str, score: str, parts: int) -> str:
    return with_ctes(_CTES + f""",
        r AS (SELECT rec, ok, action_cost, row_number() OVER (ORDER BY {score} DESC, customer_id, credit_id, relative_due_day,
                     instalment_no, amount_due) AS k FROM h),
        g AS (SELECT unnest(range(1, {parts + 1})) AS part)""", f"""
        SELECT '{strategy}' AS strategy, part / {parts}.0::DOUBLE AS contacted_pct, count(*) AS contacted, sum(rec) AS cumulative_recovery,
               sum(rec) / (SELECT total FROM tot) AS capture, sum(action_cost) AS cumulative_cost, sum(rec) - sum(action_cost) AS observed_net,
               avg(ok) AS cumulative_success_rate
        FROM g JOIN r ON k <= ((SELECT n FROM tot) * part + {parts - 1}) // {parts} GROUP BY part""")


CHECKS = {
    "strategy_benchmark": tidy_sql(with_ctes(_CTES, "SELECT * FROM det"), base_rate=9, lift=9, **_DIGITS),
    "random_benchmark": tidy_sql(with_ctes(_SIMS, "SELECT * FROM rnd"), base_rate=9, **_RANDOM),
    "benchmark_compare": tidy_sql(with_ctes(_SIMS, """
        SELECT strategy, strategy_kind, x.top_pct, contacted, success_rate, x.observed_recovery,
               mo.observed_recovery / x.observed_recovery - 1 AS model_gain, x.observed_recovery / ra.m AS lift_vs_random,
               x.observed_recovery > ra.p90 AS beats_random_p90
        FROM (SELECT * FROM det UNION ALL SELECT * EXCLUDE (random_recovery_p10, random_recovery_p90, random_net_p10, random_net_p90) FROM rnd) x
        JOIN (SELECT top_pct, observed_recovery FROM det WHERE strategy = 'Mayor valor neto esperado') mo ON x.top_pct = mo.top_pct
        JOIN (SELECT top_pct, observed_recovery AS m, random_recovery_p90 AS p90 FROM rnd) ra ON x.top_pct = ra.top_pct"""), **_COMPARED),
    "benchmark_slice": tidy_sql(with_ctes(_CTES, """
        SELECT strategy, strategy_kind, top_pct, contacted, observed_recovery FROM det WHERE top_pct = 0.1"""), observed_recovery=1),
    "recovery_curve": tidy_sql(_curve_sql("Mayor valor neto esperado", "expected_net_value", 100), cumulative_recovery=1, capture=9, observed_net=1),
    "recovery_curve_steps": tidy_sql(_curve_sql("Mayor monto vencido", "amount_due", 20), cumulative_recovery=1, capture=9, observed_net=1),
    "top_fraction": with_ctes(_CTES, """
        SELECT customer_id, credit_id, relative_due_day, instalment_no, expected_net_value, k AS position FROM (
            SELECT *, row_number() OVER (ORDER BY expected_net_value DESC, customer_id, credit_id, relative_due_day, instalment_no, amount_due) AS k FROM h)
        WHERE k <= (SELECT greatest(1, ceil(n * 0.1)) FROM tot)"""),
    "union_benchmark": with_ctes(_CTES, """
        SELECT strategy, strategy_kind, top_pct, contacted FROM det
        UNION ALL SELECT 'Aleatorio promedio (200 sims)', 'aleatoria_simulada', top_pct, contacted FROM sizes"""),
    "join_benchmark_refs": tidy_sql(with_ctes(_SIMS, """
        SELECT strategy, x.top_pct, mo.observed_recovery / x.observed_recovery - 1 AS model_gain, x.observed_recovery / ra.m AS lift_vs_random
        FROM (SELECT strategy, top_pct, observed_recovery FROM det UNION ALL SELECT strategy, top_pct, observed_recovery FROM rnd) x
        JOIN (SELECT top_pct, observed_recovery FROM det WHERE strategy = 'Mayor valor neto esperado') mo ON x.top_pct = mo.top_pct
        JOIN (SELECT top_pct, observed_recovery AS m FROM rnd) ra ON x.top_pct = ra.top_pct"""), model_gain=9, lift_vs_random=9),
}

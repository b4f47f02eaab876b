"""Contact plans on the one-row-per-credit portfolio."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from duewise import fixed_values as V
from duewise.operators import allocation, hull, views
from duewise.queries.shared import PORTFOLIO, portfolio, staged, tidy, tidy_sql, with_ctes

BUDGET = 500_000
TIGHT = {"budget": 300_000, "capacity": 600, "channel_limits": {"automatico": 200, "llamada": 150}, "per_customer": 1}
CAPACITY = 120
SMALL = {"budget": 106_000, "capacity": 80, "channel_limits": {"automatico": 30, "llamada": 40}, "per_customer": None}
_KEY = ("customer_id", "credit_id")
_TOTALS = {"cumulative_cost": 2, "cumulative_recovery": 1, "cumulative_net": 1}
_PLAN = (*_KEY, "action", "channel", "action_cost", "expected_net_value", "contact_order", "cumulative_cost",
         "cumulative_recovery", "cumulative_net")


def _greedy_rows(spark, folder, **limits):
    return tidy(allocation.plan_greedy(portfolio(spark, folder), **limits).rows.select(*_PLAN), **_TOTALS)


def _running_totals(spark, folder):
    """Totals over all candidates in contact order: what a plan without limits adds up to."""
    rows = allocation._finalise(staged(allocation.plan_candidates(portfolio(spark, folder)), "all"), "all")
    return tidy(rows.select(*_KEY, "contact_order", "cumulative_cost", "cumulative_recovery", "cumulative_net"), **_TOTALS)


def _figures(spark, summary):
    names = ("contacts", "cost_used", "budget_unused", "expected_recovery", "expected_net_value", "mean_roi")
    rows = [(n, float(summary[n])) for n in names]
    rows += [(f"channel {k}", float(v)) for k, v in summary["contacts_by_channel"].items()]
    rows += [(f"action {k}", float(v)) for k, v in summary["contacts_by_action"].items()]
    return tidy(spark.createDataFrame(rows, "figure string, value double"), value=2)


def _action_table(spark, folder):
    """Every portfolio row with three feasible actions, each with its cost and net value."""
    actions = ((V.ACTION_AUTO_MESSAGE, 250.0, 0.6), (V.ACTION_PRIORITY_CALL, 1200.0, 0.9), (V.ACTION_SPECIALIST, 5000.0, 1.0))
    offers = F.explode(F.array(*[
        F.struct(F.lit(a).alias("action"), F.lit(c).alias("action_cost"), F.lit(e).alias("effect")) for a, c, e in actions
    ]))
    base = portfolio(spark, folder).select(*_KEY, "instalment_no", "relative_due_day", "amount_due", "expected_recovery", offers.alias("o"))
    return base.select(*_KEY, "instalment_no", "relative_due_day", "amount_due", "o.action", "o.action_cost",
                       (F.col("expected_recovery") * F.col("o.effect")).alias("expected_recovery")).withColumn(
        "expected_net_value", F.col("expected_recovery") - F.col("action_cost"))


def _what_if(spark, folder):
    picked = views.portfolio_filter(portfolio(spark, folder), priorities=(V.PRIORITY_HIGH, V.PRIORITY_MEDIUM), min_amount=10000.0)
    plan = allocation.plan_contacts(picked, "greedy", budget=200_000, capacity=150, channel_limits={"especializada": 10})
    return tidy(plan.rows.select(*_PLAN), **_TOTALS)


def _rejected(spark, folder):
    """Limits taken from the portfolio's own sums, one of them wrong in each case."""
    sums = portfolio(spark, folder).agg(F.sum("action_cost").alias("cost"), F.count(F.lit(1)).alias("n")).first()
    cases = {
        "fine": {"budget": sums["cost"], "capacity": sums["n"]},
        "negative budget": {"budget": -sums["cost"]},
        "infinite budget": {"budget": sums["cost"] * float("inf")},
        "part of a contact": {"budget": sums["cost"], "capacity": sums["n"] + 0.5},
        "negative capacity": {"budget": sums["cost"], "capacity": -sums["n"]},
        "negative channel": {"budget": sums["cost"], "channel_limits": {"llamada": -sums["n"]}},
        "negative per customer": {"budget": sums["cost"], "per_customer": -sums["n"]},
    }
    rows = []
    for name, limits in cases.items():
        try:
            allocation.check_limits(**limits)
            rows.append((name, sums["n"], False))
        except ValueError:
            rows.append((name, sums["n"], True))
    return spark.createDataFrame(rows, "limits string, candidates long, rejected boolean")


def _best_by_capacity(spark, folder):
    """Capacity as the only limit: the best row of each customer, and of those the most valuable."""
    plan = allocation.plan_optimised(portfolio(spark, folder), budget=1e12, capacity=CAPACITY, gap=0.0)
    return plan.rows.select(*_KEY, "action", "expected_net_value", "contact_order")


def _best_assignment(spark, folder):
    """No limit binds: each customer's most valuable action."""
    plan = allocation.plan_action_assignment(_action_table(spark, folder), budget=1e12, entity=["customer_id"], gap=0.0)
    return tidy(plan.rows.select("customer_id", "action", "expected_net_value"), expected_net_value=6)


def _exact(spark, folder):
    """The best value under all shared limits, proven: nothing is left between plan and bound."""
    plan = allocation.plan_optimised(portfolio(spark, folder), gap=0.0, **SMALL)
    s = plan.summary
    proven = s["upper_bound"] - s["expected_net_value"] <= 1e-6 * s["expected_net_value"]
    return tidy(spark.createDataFrame([(s["budget"], s["expected_net_value"], bool(proven))], "budget double, expected_net_value double, proven boolean"),
                expected_net_value=1)


def _action_rows(table):
    """Feasible actions as rows of whom, id, cost and value."""
    rows = allocation.plan_candidates(table, entity=["customer_id"])
    number = F.dense_rank().over(Window.partitionBy("customer_id").orderBy("credit_id", "action_cost"))
    return rows.select(F.col("entity_key").alias("who"), number.cast("long").alias("id"), "action_cost", "expected_net_value")


def _hull_rows(spark, folder):
    steps = hull.hull_steps(staged(_action_rows(_action_table(spark, folder)), "actions"))
    return tidy(steps.select(F.col("who").cast("long").alias("customer_id"), "step", "cost", "value", "efficiency"), value=6, efficiency=9)


def _lp_optimum(spark, folder):
    """The best fractional assignment, the whole steps of it, and the step between the two."""
    table = _action_table(spark, folder)
    found = hull.merge_steps(hull.hull_steps(staged(_action_rows(table), "actions")), BUDGET)
    whole = allocation.plan_action_assignment(table, budget=BUDGET, entity=["customer_id"])
    s = whole.summary
    within = found.bound - s["expected_net_value"] <= found.step_value + 1e-6 and s["cost_used"] <= BUDGET + 1e-6
    rows = [("fractional optimum", found.bound), ("whole steps", found.value), ("price", found.price), ("next step", found.step_value),
            ("within a step", float(within))]
    return tidy(spark.createDataFrame(rows, "figure string, value double"), value=4)


def _tight(spark, folder):
    """Whether the optimised plan keeps each limit, beats greedy, and lies below its own bound."""
    rows = portfolio(spark, folder)
    plan, greedy = allocation.plan_optimised(rows, **TIGHT), allocation.plan_greedy(rows, **TIGHT)
    s = plan.summary
    most = plan.rows.groupBy("customer_id").count().agg(F.max("count").alias("m")).first()["m"]
    checks = {
        "budget": s["cost_used"] <= TIGHT["budget"] + 1e-6, "capacity": s["contacts"] <= TIGHT["capacity"],
        **{f"channel {c}": s["contacts_by_channel"].get(c, 0) <= n for c, n in TIGHT["channel_limits"].items()},
        "customer": most <= TIGHT["per_customer"], "not below greedy": s["expected_net_value"] >= greedy.summary["expected_net_value"] - 1e-6,
        "bound": s["upper_bound"] >= s["expected_net_value"] - 1e-6,
    }
    return spark.createDataFrame([(k, bool(v)) for k, v in checks.items()], "limit string, kept boolean")


def _compare_greedy(spark, folder):
    """The greedy side of the comparison; the optimised one has no SQL form."""
    return tidy(
        allocation.plan_compare(portfolio(spark, folder), budget=BUDGET).where("method = 'greedy'")
        .select("method", "contacts", "cost_used", "expected_recovery", "expected_net_value"),
        cost_used=2, expected_recovery=1, expected_net_value=1)


QUERIES = {
    "plan_validation": _rejected,
    "plan_dispatch": lambda s, d: allocation.plan_contacts(portfolio(s, d), "greedy", **TIGHT).rows.select(*_KEY, "action", "channel", "method"),
    "plan_optimised_capacity": _best_by_capacity,
    "plan_action_assignment_free": _best_assignment,
    "plan_optimised_limits": _tight,
    "plan_optimised_exact": _exact,
    "plan_action_hull": _hull_rows,
    "plan_action_lp": _lp_optimum,
    "plan_compare_greedy": _compare_greedy,
    "plan_candidates": lambda s, d: allocation.plan_candidates(portfolio(s, d), 1000.0).select(
        *_KEY, "channel", "roi", "entity_key", "expected_net_value"),
    "net_value_floor": lambda s, d: allocation.plan_candidates(portfolio(s, d), 25000.0).groupBy("channel").agg(
        F.count(F.lit(1)).alias("rows")),
    "plan_running_totals": _running_totals,
    "plan_greedy": lambda s, d: _greedy_rows(s, d, budget=BUDGET),
    "plan_greedy_limits": lambda s, d: _greedy_rows(s, d, **TIGHT),
    "plan_summary": lambda s, d: _figures(s, allocation.plan_greedy(portfolio(s, d), **TIGHT).summary),
    "plan_optimised": lambda s, d: allocation.plan_optimised(portfolio(s, d), **TIGHT).rows.select(*_PLAN),
    "plan_action_assignment": lambda s, d: allocation.plan_action_assignment(
        _action_table(s, d), budget=BUDGET, entity=["customer_id"]).rows.select(*_PLAN),
    "plan_compare": lambda s, d: allocation.plan_compare(portfolio(s, d), budget=BUDGET),
    "what_if_plan": _what_if,
}

_CAND = PORTFOLIO + """,
    cand AS (
        SELECT *, CASE WHEN regexp_matches(lower(action), 'descuento|especializada|especialista') THEN 'especializada'
                       WHEN regexp_matches(lower(action), 'llamada|telef') THEN 'llamada'
                       WHEN regexp_matches(lower(action), 'whatsapp|sms|automático|automatico|monitoreo|postergar|recordatorio') THEN 'automatico'
                       ELSE 'manual' END AS channel, expected_net_value / action_cost AS roi
        FROM portfolio WHERE expected_net_value >= {floor}{where})"""


def _greedy_ctes(budget, capacity=None, channels=None, floor=0, where="") -> str:
    """The sequential rule, one row at a time: the state rides along in a recursive query."""
    channels = channels or {}
    room = f"AND g.n < {capacity}" if capacity is not None else ""
    test = f"""g.used + c.action_cost <= {budget} + 1e-9 {room} AND NOT list_contains(g.who, c.customer_id)""" + "".join(
        f" AND (c.channel <> '{ch}' OR g.n_{i} < {n})" for i, (ch, n) in enumerate(channels.items()))
    counters = "".join(f", 0::BIGINT AS n_{i}" for i in range(len(channels)))
    steps = "".join(
        f", g.n_{i} + CASE WHEN {test} AND c.channel = '{ch}' THEN 1 ELSE 0 END" for i, ch in enumerate(channels))
    return _CAND.format(floor=floor, where=where) + f""",
    ord AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY roi DESC, expected_net_value DESC, expected_recovery DESC, customer_id, credit_id) AS k FROM cand),
    g AS (
        SELECT 0::BIGINT AS k, 0.0::DOUBLE AS used, 0::BIGINT AS n, []::BIGINT[] AS who, false AS hit{counters}
        UNION ALL
        SELECT c.k, g.used + CASE WHEN {test} THEN c.action_cost ELSE 0 END, g.n + CASE WHEN {test} THEN 1 ELSE 0 END,
               CASE WHEN {test} THEN list_append(g.who, c.customer_id) ELSE g.who END, {test}{steps}
        FROM g JOIN ord c ON c.k = g.k + 1),
    plan AS (
        SELECT customer_id, credit_id, action, channel, action_cost, expected_recovery, expected_net_value, roi, row_number() OVER w AS contact_order,
               sum(action_cost) OVER w AS cumulative_cost, sum(expected_recovery) OVER w AS cumulative_recovery,
               sum(expected_net_value) OVER w AS cumulative_net
        FROM ord WHERE k IN (SELECT k FROM g WHERE hit)
        WINDOW w AS (ORDER BY expected_net_value DESC, roi DESC, expected_recovery DESC, customer_id, credit_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def _recursive(ctes: str, body: str) -> str:
    return f"WITH RECURSIVE {ctes} {body}"


_OFFERS = PORTFOLIO + """,
    offers AS (
        SELECT customer_id, credit_id, a.cost, expected_recovery * a.effect - a.cost AS value
        FROM portfolio, (VALUES (250.0::DOUBLE, 0.6::DOUBLE), (1200.0, 0.9), (5000.0, 1.0)) a(cost, effect)),
    pt AS (SELECT customer_id, cost, max(value) AS value FROM offers WHERE value > 0 GROUP BY ALL),
    p0 AS (SELECT * FROM pt UNION ALL SELECT DISTINCT customer_id, 0, 0 FROM pt),
    -- on the hull: reached more steeply from every cheaper point than left for any dearer one, and worth more than nothing
    hull AS (SELECT p.* FROM pt p WHERE
        (SELECT min((p.value - q.value) / (p.cost - q.cost)) FROM p0 q WHERE q.customer_id = p.customer_id AND q.cost < p.cost) >
        greatest(0, coalesce((SELECT max((q.value - p.value) / (q.cost - p.cost)) FROM p0 q WHERE q.customer_id = p.customer_id AND q.cost > p.cost), 0))),
    steps AS (SELECT customer_id, row_number() OVER w::INT AS step, cost, value, cost - coalesce(lag(cost) OVER w, 0) AS extra_cost,
                     value - coalesce(lag(value) OVER w, 0) AS extra_value, extra_value / extra_cost AS efficiency
              FROM hull WINDOW w AS (PARTITION BY customer_id ORDER BY cost))"""
_P = ", ".join(_PLAN)
_TIGHT_CTES = _greedy_ctes(300000, 600, {"automatico": 200, "llamada": 150})
CHECKS = {
    "plan_validation": with_ctes(PORTFOLIO, """
        SELECT unnest(['fine', 'negative budget', 'infinite budget', 'part of a contact', 'negative capacity', 'negative channel',
                       'negative per customer']) AS limits, (SELECT count(*) FROM portfolio) AS candidates,
               unnest([false, true, true, true, true, true, true]) AS rejected"""),
    "plan_dispatch": _recursive(_TIGHT_CTES, "SELECT customer_id, credit_id, action, channel, 'greedy' AS method FROM plan"),
    "plan_optimised_capacity": with_ctes(_CAND.format(floor=0, where=""), f"""
        SELECT customer_id, credit_id, action, expected_net_value, row_number() OVER w AS contact_order FROM (
            SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY expected_net_value DESC, roi DESC, credit_id) = 1)
        WINDOW w AS (ORDER BY expected_net_value DESC, roi DESC, expected_recovery DESC, customer_id, credit_id)
        QUALIFY contact_order <= {CAPACITY}"""),
    "plan_action_assignment_free": tidy_sql(with_ctes(PORTFOLIO + """,
        offers AS (
            SELECT customer_id, credit_id, a.action, expected_recovery * a.effect - a.cost AS expected_net_value
            FROM portfolio, (VALUES ('WhatsApp/SMS automático', 250.0::DOUBLE, 0.6::DOUBLE), ('Llamada prioritaria', 1200.0, 0.9),
                             ('Oferta de descuento / gestión especializada', 5000.0, 1.0)) a(action, cost, effect))""", """
        SELECT customer_id, action, expected_net_value FROM offers WHERE expected_net_value >= 0
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY expected_net_value DESC) = 1"""), expected_net_value=6),
    "plan_optimised_limits": """
        SELECT unnest(['budget', 'capacity', 'channel automatico', 'channel llamada', 'customer', 'not below greedy', 'bound']) AS limit,
               true AS kept""".replace("AS limit", 'AS "limit"'),
    # Costs follow from the action, so the best plan takes the most valuable rows of each cost level: all numbers are tried.
    "plan_optimised_exact": tidy_sql(with_ctes(_CAND.format(floor=0, where="") + """,
        r AS (SELECT action_cost, row_number() OVER w AS k, sum(expected_net_value) OVER w AS v FROM cand
              WINDOW w AS (PARTITION BY action_cost ORDER BY expected_net_value DESC ROWS UNBOUNDED PRECEDING)),
        n AS (SELECT action_cost, k, v FROM r UNION ALL SELECT DISTINCT action_cost, 0, 0 FROM r),
        a AS (SELECT x.k + y.k AS k, 150 * x.k + 250 * y.k AS cost, x.v + y.v AS v FROM n x, n y
              WHERE x.action_cost = 150 AND y.action_cost = 250 AND x.k + y.k <= 30),
        l AS (SELECT x.k + y.k AS k, 1200 * x.k + 1300 * y.k AS cost, x.v + y.v AS v FROM n x, n y
              WHERE x.action_cost = 1200 AND y.action_cost = 1300 AND x.k + y.k <= 40),
        b AS (SELECT a.v + l.v AS v, least((106000 - a.cost - l.cost) // 5000, 80 - a.k - l.k) AS room FROM a, l
              WHERE a.cost + l.cost <= 106000 AND a.k + l.k <= 80)""", """
        SELECT 106000.0::DOUBLE AS budget, max(b.v + n.v) AS expected_net_value, true AS proven FROM b JOIN n ON n.action_cost = 5000 AND n.k <= b.room"""),
        expected_net_value=1),
    "plan_action_hull": tidy_sql(with_ctes(_OFFERS, "SELECT customer_id, step, cost, value, efficiency FROM steps"), value=6, efficiency=9),
    "plan_action_lp": tidy_sql(with_ctes(_OFFERS + f""",
        o AS (SELECT *, sum(extra_cost) OVER w AS c, sum(extra_value) OVER w AS v FROM steps
              WINDOW w AS (ORDER BY efficiency DESC, customer_id::VARCHAR, step ROWS UNBOUNDED PRECEDING)),
        e AS (SELECT * FROM o WHERE c > {BUDGET} + 1e-9 ORDER BY c LIMIT 1)""", f"""
        SELECT 'fractional optimum' AS figure, v - extra_value + efficiency * ({BUDGET} - c + extra_cost) AS value FROM e
        UNION ALL SELECT 'whole steps', v - extra_value FROM e UNION ALL SELECT 'price', efficiency FROM e
        UNION ALL SELECT 'next step', extra_value FROM e UNION ALL SELECT 'within a step', 1.0 FROM e"""), value=4),
    "plan_compare_greedy": tidy_sql(_recursive(_greedy_ctes(BUDGET), """
        SELECT 'greedy' AS method, count(*) AS contacts, sum(action_cost) AS cost_used, sum(expected_recovery) AS expected_recovery,
               sum(expected_net_value) AS expected_net_value FROM plan"""), cost_used=2, expected_recovery=1, expected_net_value=1),
    "plan_candidates": with_ctes(_CAND.format(floor=1000, where=""), """
        SELECT customer_id, credit_id, channel, roi, customer_id || '|' || credit_id AS entity_key, expected_net_value FROM cand"""),
    "net_value_floor": with_ctes(_CAND.format(floor=25000, where=""), "SELECT channel, count(*) AS rows FROM cand GROUP BY channel"),
    "plan_running_totals": tidy_sql(with_ctes(_CAND.format(floor=0, where=""), """
        SELECT customer_id, credit_id, row_number() OVER w AS contact_order, sum(action_cost) OVER w AS cumulative_cost,
               sum(expected_recovery) OVER w AS cumulative_recovery, sum(expected_net_value) OVER w AS cumulative_net
        FROM cand WINDOW w AS (ORDER BY expected_net_value DESC, roi DESC, expected_recovery DESC, customer_id, credit_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""), **_TOTALS),
    "plan_greedy": tidy_sql(_recursive(_greedy_ctes(BUDGET), f"SELECT {_P} FROM plan"), **_TOTALS),
    "plan_greedy_limits": tidy_sql(_recursive(_TIGHT_CTES, f"SELECT {_P} FROM plan"), **_TOTALS),
    "plan_summary": tidy_sql(_recursive(_TIGHT_CTES, """
        SELECT 'contacts' AS figure, count(*)::DOUBLE AS value FROM plan
        UNION ALL SELECT 'cost_used', sum(action_cost) FROM plan
        UNION ALL SELECT 'budget_unused', 300000 - sum(action_cost) FROM plan
        UNION ALL SELECT 'expected_recovery', sum(expected_recovery) FROM plan
        UNION ALL SELECT 'expected_net_value', sum(expected_net_value) FROM plan
        UNION ALL SELECT 'mean_roi', avg(roi) FROM plan
        UNION ALL SELECT 'channel ' || channel, count(*) FROM plan GROUP BY channel
        UNION ALL SELECT 'action ' || action, count(*) FROM plan GROUP BY action"""), value=2),
    "what_if_plan": tidy_sql(_recursive(_greedy_ctes(
        200000, 150, {"especializada": 10}, where=" AND priority IN ('Alta', 'Media') AND amount_due >= 10000"),
        f"SELECT {_P} FROM plan"), **_TOTALS),
}

"""Choice of contacts under a budget, a capacity, channel limits and a cap per customer.

The greedy rule is sequential by nature: take the next row unless a limit forbids it. It is carried
out in rounds of aggregates over ranked rows. Within a round the limits left are fixed, so the rows
taken are a prefix of the rows still open, and its end is found by adding up ever finer ranges of
ranks. Each round's end closes a cost level, a channel or the capacity for good.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duewise import fixed_values as V
from duewise.functions.expressions import clip, entity_key, fill_zero, infer_channel, require_columns, safe_roi, to_number
from duewise.operators.core import Branching, Core, flip_losses
from duewise.operators.decision import tie_breakers
from duewise.operators.hull import hull_steps, merge_steps
from duewise.operators.ordering import running
from duewise.session import staged

KNOWN_CHANNELS = (V.CHANNEL_AUTO, V.CHANNEL_CALL, V.CHANNEL_SPECIALIST, V.CHANNEL_MANUAL)
CANDIDATE_COLUMNS = ("expected_net_value", "expected_recovery", "action_cost")
TOLERANCE = 1e-9
RANGES = 4_096  # rank ranges added up per look; as many small rows reach the driver
GAP = 0.001  # a plan this near its bound, in parts of its value, ends the search
SEARCH_PASSES = 7  # passes over the rows before a plan is made, and again before each further one
MOST_PLANS = 4
POINTS = 12  # sets of prices tried per pass
CORE_ROWS = 1_000  # rows that are branched on at most, and as many small rows reach the driver
NODES = 300  # looked at per round


@dataclass(frozen=True)
class Limits:
    budget: float
    capacity: int | None = None
    channels: dict[str, int] = field(default_factory=dict)
    per_customer: int | None = 1


@dataclass(frozen=True)
class Plan:
    rows: DataFrame
    summary: dict


def _whole(name: str, value) -> int | None:
    if value is None:
        return None
    if not math.isfinite(float(value)) or value < 0 or int(value) != value:
        raise ValueError(f"{name} must be a whole number that is not negative: {value!r}")
    return int(value)


def check_limits(budget, capacity=None, channel_limits=None, per_customer=1) -> Limits:
    """Validated limits; channel names are normalised and unlimited channels dropped."""
    if budget is None or not math.isfinite(float(budget)) or budget < 0:
        raise ValueError(f"budget must be finite and not negative: {budget!r}")
    channels = {}
    for name, limit in (channel_limits or {}).items():
        if limit is not None:
            if not math.isfinite(float(limit)) or limit < 0:
                raise ValueError(f"limit of channel {name} must be finite and not negative: {limit!r}")
            channels[str(name).lower().strip()] = int(limit)
    return Limits(float(budget), _whole("capacity", capacity), channels, _whole("contacts per customer", per_customer))


def plan_candidates(df: DataFrame, min_net: float = 0.0, entity: list[str] | None = None) -> DataFrame:
    """Cleaned rows worth at least the floor, with channel, ROI and entity key: one projection."""
    require_columns(df, CANDIDATE_COLUMNS, "plan")
    if "channel" in df.columns:
        channel = F.coalesce(F.col("channel").cast("string"), F.lit(V.CHANNEL_MANUAL))
    elif "action" in df.columns:
        channel = infer_channel(F.col("action"))
    else:
        channel = F.lit(V.CHANNEL_MANUAL)
    clean = df.withColumns({
        "action_cost": clip(fill_zero(to_number(F.col("action_cost"))), low=0.0),
        "expected_net_value": to_number(F.col("expected_net_value")),
        "expected_recovery": clip(fill_zero(to_number(F.col("expected_recovery"))), low=0.0),
        "channel": F.trim(F.lower(channel)),
    })
    net = F.col("expected_net_value")
    clean = clean.where((net >= float(min_net)) & (F.abs(net) < float("inf")))
    keys = [c for c in (entity or ["customer_id", "credit_id"]) if c in df.columns]
    # Without any key each row is its own entity.
    key = entity_key(*[F.col(c) for c in keys]) if keys else F.uuid(F.lit(7))
    return clean.withColumns({"roi": safe_roi(net, F.col("action_cost")), "entity_key": key})


def _greedy_order(df: DataFrame) -> list[Column]:
    return [F.col(c).desc() for c in ("roi", "expected_net_value", "expected_recovery")] + _ties(df)


def _ties(df: DataFrame) -> list[Column]:
    extra = [F.col("action").asc_nulls_last()] if "action" in df.columns else []
    return [*tie_breakers(df), *extra, F.col("entity_key")]


def _narrow(ranked: DataFrame, who: str | None) -> DataFrame:
    """``who`` is whom a contact counts for; a row without one, or every row if None, is its own."""
    own = F.concat(F.lit("row "), F.col("position").cast("string"))
    named = own if who is None else F.coalesce(F.concat(F.lit("key "), F.col(who).cast("string")), own)
    return ranked.select(
        "position", F.col("position").alias("id"), named.alias("who"), "action_cost", "channel", "expected_net_value"
    )


def _greedy(ranked: DataFrame, limits: Limits) -> DataFrame:
    """Ids the sequential rule takes, walking ``ranked`` (position, id, who, action_cost, channel)."""
    rows = ranked.agg(F.max("position")).first()[0] or 0
    left, room, slots = limits.budget, limits.capacity, dict(limits.channels)
    done, taken = 0, []
    while room is None or room > 0:
        closed = [c for c, n in slots.items() if n <= 0]
        still = ranked.where((F.col("position") > done) & (F.col("action_cost") <= left + TOLERANCE))
        if closed:
            still = still.where(~F.col("channel").isin(*closed))
        if limits.per_customer is not None:
            still = _first_per_customer(still, taken, limits.per_customer)
        still = staged(still.select("position", "id", "who", "action_cost", "channel"), "round")
        end, spent, used, by_channel = _first_break(still, done, rows, left, room, slots)
        taken.append(still if end is None else still.where(F.col("position") < end))
        if end is None:
            break
        left, done = left - spent, end - 1
        room = None if room is None else room - used
        slots = {c: n - by_channel[c] for c, n in slots.items()}
    if not taken:
        return ranked.where(F.lit(False)).select("id")
    ids = taken[0]
    for more in taken[1:]:
        ids = ids.unionByName(more)
    return ids.select("id")


def _first_per_customer(still: DataFrame, taken: list[DataFrame], cap: int) -> DataFrame:
    """Open rows a customer still has room for. The rank limit is applied within tasks first."""
    best = Window.partitionBy("who").orderBy("position")
    kept = still.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= cap)
    if not taken:
        return kept
    before = taken[0].select("who")
    for more in taken[1:]:
        before = before.unionByName(more.select("who"))
    counts = before.groupBy("who").agg(F.count(F.lit(1)).alias("_taken"))
    return kept.join(counts, "who", "left").where(F.col("_rank") + F.coalesce(F.col("_taken"), F.lit(0)) <= cap)


def _first_break(still: DataFrame, low: int, high: int, left: float, room: int | None, slots: dict[str, int]):
    """(rank of the first row past a limit or None, cost, rows and rows per channel before it)."""
    spent, used, by_channel = 0.0, 0, {c: 0 for c in slots}
    while True:
        step = max(1, math.ceil((high - low) / RANGES))
        part = F.expr(f"(position - {low + 1}) DIV {step}")
        sums = (
            still.where((F.col("position") > low) & (F.col("position") <= high))
            .groupBy(part.alias("part"))
            .agg(
                F.sum("action_cost").alias("cost"), F.count(F.lit(1)).alias("n"),
                *[F.count_if(F.col("channel") == c).alias(f"n_{i}") for i, c in enumerate(slots)],
            )
            .collect()
        )
        hit = None
        for r in sorted(sums, key=lambda r: r["part"]):
            channels = {c: by_channel[c] + r[f"n_{i}"] for i, c in enumerate(slots)}
            over = (
                spent + r["cost"] > left + TOLERANCE
                or (room is not None and used + r["n"] > room)
                or any(channels[c] > slots[c] for c in slots)
            )
            if over:
                hit = r["part"]
                break
            spent, used, by_channel = spent + r["cost"], used + r["n"], channels
        if hit is None:
            return None, spent, used, by_channel
        low, high = low + hit * step, min(high, low + (hit + 1) * step)
        if step == 1:
            return high, spent, used, by_channel


def _finalise(chosen: DataFrame, method: str) -> DataFrame:
    """Contact order by value with running totals, added up by segments of that order."""
    order = [F.col(c).desc() for c in ("expected_net_value", "roi", "expected_recovery")] + _ties(chosen)
    totals = {
        "cumulative_cost": F.col("action_cost"),
        "cumulative_recovery": F.col("expected_recovery"),
        "cumulative_net": F.col("expected_net_value"),
    }
    return running(chosen, order, sums=totals, position="contact_order").drop("entity_key").withColumn("method", F.lit(method))


def summarise(plan: DataFrame, method: str, limits: Limits, status: str, success: bool = True, bound=None) -> dict:
    """Figures of a plan. One row per (channel, action) label pair reaches the driver."""
    finite = F.when(F.col("roi") < float("inf"), F.col("roi"))
    action = F.col("action") if "action" in plan.columns else F.lit(None).cast("string")
    groups = plan.groupBy("channel", action.alias("action")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("action_cost").alias("cost"), F.sum("expected_recovery").alias("recovery"),
        F.sum("expected_net_value").alias("net"), F.sum(finite).alias("roi"), F.count(finite).alias("roi_n"),
    ).collect()
    total = {k: sum(g[k] or 0 for g in groups) for k in ("n", "cost", "recovery", "net", "roi", "roi_n")}
    by_channel, by_action = {}, {}
    for g in groups:
        by_channel[g["channel"]] = by_channel.get(g["channel"], 0) + g["n"]
        if g["action"] is not None:
            by_action[g["action"]] = by_action.get(g["action"], 0) + g["n"]
    net = float(total["net"])
    return {
        "method": method,
        "status": status if groups else "empty_candidates",
        "success": success,
        "objective_value": net,
        "upper_bound": None if bound is None else float(bound),
        "gap": None if bound is None else max(0.0, (bound - net) / max(abs(net), 1.0)),
        "budget": limits.budget,
        "capacity": limits.capacity,
        "channel_limits": {c: limits.channels.get(c) for c in (*KNOWN_CHANNELS, *limits.channels)},
        "contacts_per_customer": limits.per_customer,
        "contacts": int(total["n"]),
        "cost_used": float(total["cost"]),
        "budget_unused": limits.budget - float(total["cost"]),
        "expected_recovery": float(total["recovery"]),
        "expected_net_value": net,
        "mean_roi": total["roi"] / total["roi_n"] if total["roi_n"] else None,
        "contacts_by_channel": by_channel,
        "contacts_by_action": by_action,
    }


def rebuild_summary(plan: DataFrame, budget, capacity=None, channel_limits=None, per_customer=1) -> dict:
    """Summary of a plan read back from storage, where only its rows are left."""
    limits = check_limits(budget, capacity, channel_limits, per_customer)
    row = plan.select("method").first() if "method" in plan.columns else None
    return summarise(plan, row["method"] if row else "unknown", limits, "not_available", success=False)


def summary_row(spark: SparkSession, summary: dict) -> DataFrame:
    """The summary as one row for a JSON sink."""
    return spark.createDataFrame(
        [tuple(summary.values())],
        "method string, status string, success boolean, objective_value double, upper_bound double, gap double, "
        "budget double, capacity long, channel_limits map<string,long>, contacts_per_customer long, contacts long, "
        "cost_used double, budget_unused double, expected_recovery double, expected_net_value double, mean_roi double, "
        "contacts_by_channel map<string,long>, contacts_by_action map<string,long>",
    )


def _who(df: DataFrame, entity: bool) -> str | None:
    return "entity_key" if entity else "customer_id" if "customer_id" in df.columns else None


def plan_greedy(
    df: DataFrame, budget: float = 500_000, capacity=None, min_net: float = 0.0, channel_limits=None, per_customer=1
) -> Plan:
    """Best ROI first, as long as every limit holds."""
    limits = check_limits(budget, capacity, channel_limits, per_customer)
    candidates = staged(plan_candidates(df, min_net), "candidates")
    ranked = running(candidates, _greedy_order(candidates))
    ids = _greedy(_narrow(ranked, _who(df, False)), limits)
    return _finished(ranked, ids, "greedy", limits, "heuristic")


def _finished(ranked: DataFrame, ids: DataFrame, method: str, limits: Limits, status: str, bound=None) -> Plan:
    chosen = staged(ranked.join(ids, ranked["position"] == ids["id"], "left_semi").drop("position"), "chosen")
    rows = _finalise(chosen, method)
    return Plan(rows, summarise(rows, method, limits, status, bound=bound))


def _uses(limits: Limits) -> list[tuple[Column, float]]:
    """What a row uses of each shared limit, and the limit."""
    uses = [(F.col("action_cost"), limits.budget)]
    if limits.capacity is not None:
        uses.append((F.lit(1.0), limits.capacity))
    return uses + [((F.col("channel") == c).cast("double"), n) for c, n in limits.channels.items()]


def _reduced(prices: list[Column], limits: Limits) -> Column:
    """Net value less the price of what the row uses."""
    out = F.col("expected_net_value")
    for price, (use, _) in zip(prices, _uses(limits)):
        out = out - price * use
    return out


def _bounds(rows: DataFrame, points: np.ndarray, limits: Limits) -> list[tuple[float, np.ndarray]]:
    """For each set of prices: an upper bound on the best plan, and its slope in the prices.

    Any prices give a valid bound: the priced value of the best rows each customer may have, plus the
    worth of the limits. Rows are tried against every set inside their task and added up there first.
    The prices are one constant array, so the generated code is the same in every pass.
    """
    uses = _uses(limits)
    names = [f"use_{k}" for k in range(len(uses))]
    table = F.array(*[
        F.struct(F.lit(i).alias("point"), *[F.lit(float(v)).alias(f"price_{k}") for k, v in enumerate(x)])
        for i, x in enumerate(points)
    ])
    prices = [F.col(f"t.price_{k}") for k in range(len(uses))]
    tried = (
        rows.select("who", "channel", "action_cost", "expected_net_value", F.explode(table).alias("t"))
        .select("who", "t.point", _reduced(prices, limits).alias("reduced"), *[u.alias(n) for (u, _), n in zip(uses, names)])
        .where(F.col("reduced") > 0)
    )
    if limits.per_customer == 1:
        tried = tried.groupBy("who", "point").agg(F.max(F.struct("reduced", *names)).alias("b")).select("point", "b.*")
    elif limits.per_customer is not None:
        best = Window.partitionBy("who", "point").orderBy(F.col("reduced").desc())
        tried = tried.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= limits.per_customer)
    sums = {
        r["point"]: r for r in tried.groupBy("point").agg(F.sum("reduced").alias("s"), *[F.sum(n).alias(n) for n in names]).collect()
    }
    limit = np.array([float(n) for _, n in uses])
    out = []
    for i, x in enumerate(points):
        used = np.array([sums[i][n] for n in names]) if i in sums else np.zeros(len(names))
        out.append((float((sums[i]["s"] if i in sums else 0.0) + x @ limit), limit - used))
    return out


def _next_points(cuts: list, best: np.ndarray, top: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Prices to try next: low spots of the planes seen so far, which lie below the bound everywhere.

    There are as many unknowns as limits, so a few random moves on the driver find such spots.
    """
    slopes = np.array([g for _, g, _ in cuts])
    heights = np.array([v - g @ x for v, g, x in cuts])
    points = []
    for j in range(POINTS):
        x, width = best.copy(), np.maximum(best, top * 0.01) * (0.5 if j % 2 else 1.0)
        low = (heights + slopes @ x).max()
        for _ in range(60):
            moves = np.clip(x + draw.normal(size=(64, len(x))) * width, 0.0, top)
            planes = (heights[:, None] + slopes @ moves.T).max(axis=0)
            i = planes.argmin()
            if planes[i] < low:
                x, low = moves[i], planes[i]
            else:
                width = width * 0.7
        points.append(x if j % 3 else (x + best) / 2)
    return np.array(points)


class _Search:
    """Prices with a low bound, by cutting planes (Kelley, SIAM 1960), over all rows."""

    def __init__(self, pruned: DataFrame, limits: Limits):
        top_row = pruned.agg(
            F.max(F.when(F.col("action_cost") > 0, F.col("expected_net_value") / F.col("action_cost"))).alias("roi"),
            F.max("expected_net_value").alias("net"),
        ).first()
        n = len(_uses(limits))
        self.limits, self.bound, self.cuts = limits, math.inf, []
        self.top = np.array([top_row["roi"] or 0.0] + [top_row["net"] or 0.0] * (n - 1))
        # Rows of a customer stay in one partition, so no pass shuffles them; lost blocks are read again.
        self.rows = pruned.repartition("who").persist()
        self.draw = np.random.default_rng(7)
        self.points = np.vstack([np.zeros(n), self.top * 10 ** self.draw.uniform(-3, 0, (POINTS - 1, n))])
        self.best = self.points[0]

    def look(self, passes: int = SEARCH_PASSES) -> list[float]:
        """Prices with the lowest bound after some more passes."""
        for _ in range(passes):
            for x, (value, slope) in zip(self.points, _bounds(self.rows, self.points, self.limits)):
                self.cuts.append((value, slope, x))
                if value < self.bound:
                    self.best, self.bound = x, value
            self.points = _next_points(self.cuts, self.best, self.top, self.draw)
        return [float(v) for v in self.best]

    def end(self) -> None:
        self.rows.unpersist()


def _undominated(narrow: DataFrame, per_customer: int | None) -> DataFrame:
    """Of a customer's rows with equal cost and channel, only the most valuable can ever be chosen."""
    if per_customer is None:
        return narrow
    best = Window.partitionBy("who", "channel", "action_cost").orderBy(F.col("expected_net_value").desc(), "position")
    return narrow.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= per_customer).drop("_rank")


def _branched(search: _Search, prices: list[float], limits: Limits, value: float, gap: float):
    """Settle rows by reduced cost and branch on the rest.

    Returns (value, ids, bound, share of rows settled); ids are None where no better plan was found.
    The rows nearest to their turning point reach the driver, at most CORE_ROWS. If more are open,
    the others keep their priced choice, and the bound stays that of the prices.
    """
    slack = search.bound - value + 1e-9 * abs(search.bound)
    lost = flip_losses(search.rows, _reduced([F.lit(v) for v in prices], limits), limits.per_customer)
    lost = staged(lost.select("id", "who", "action_cost", "channel", "expected_net_value", "taken", "loss"), "losses")
    counts = lost.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("loss") <= slack).alias("open")).first()
    settled = 1.0 - counts["open"] / max(1, counts["rows"])
    near = lost.where(F.col("loss") <= slack).orderBy("loss", "id").limit(CORE_ROWS).collect()
    fixed = lost.where("taken")
    if near:
        edge = F.struct(F.lit(float(near[-1]["loss"])).alias("loss"), F.lit(int(near[-1]["id"])).alias("id"))
        fixed = fixed.where(F.struct("loss", "id") > edge)
    uses = _uses(limits)
    sums = fixed.agg(F.sum("expected_net_value").alias("value"), *[F.sum(u).alias(f"use_{k}") for k, (u, _) in enumerate(uses)]).first()
    limit = np.array([float(n) - (sums[f"use_{k}"] or 0.0) for k, (_, n) in enumerate(uses)])
    base = sums["value"] or 0.0
    if not near:
        # Turning any row costs more than could be gained: the priced choice is best, or what is known already.
        better = base > value and (limit >= -TOLERANCE).all()
        return max(value, base) if better else value, fixed.select("id") if better else None, max(value, base) if better else value, settled
    numbers = {who: k for k, who in enumerate(dict.fromkeys(r["who"] for r in near))}
    room = np.full(len(numbers), len(near) if limits.per_customer is None else limits.per_customer)
    if limits.per_customer is not None:
        known = lost.sparkSession.createDataFrame([(w,) for w in numbers], "who string")
        for r in fixed.join(F.broadcast(known), "who").groupBy("who").count().collect():
            room[numbers[r["who"]]] -= r["count"]
    core = Core(
        ids=np.array([r["id"] for r in near]), value=np.array([r["expected_net_value"] for r in near], float),
        uses=np.array([[r["action_cost"], *([1.0] if limits.capacity is not None else []), *[float(r["channel"] == c) for c in limits.channels]]
                       for r in near]),
        customer=np.array([numbers[r["who"]] for r in near]), room=room, limit=limit,
    )
    found = Branching(core, np.array(prices), known=value - base)
    found.run(near=gap * max(abs(value), 1.0), most_nodes=NODES)
    bound = max(found.value, found.bound) + base if counts["open"] <= CORE_ROWS else search.bound
    if found.chosen is None:
        return value, None, min(search.bound, bound), settled
    picked = lost.sparkSession.createDataFrame([(int(i),) for i in core.ids[found.chosen]], "id long")
    return found.value + base, fixed.select("id").unionByName(picked), min(search.bound, bound), settled


def _optimise(
    df: DataFrame, limits: Limits, min_net: float, entity: list[str] | None, by_entity: bool, method: str, gap: float = GAP
) -> Plan:
    candidates = staged(plan_candidates(df, min_net, entity), "candidates")
    ranked = running(candidates, _greedy_order(candidates))
    narrow = staged(_narrow(ranked, _who(df, by_entity)), "narrow")
    pruned = staged(_undominated(narrow, limits.per_customer), "pruned")

    def worth(ids: DataFrame) -> float:
        return narrow.join(ids, "id", "left_semi").agg(F.sum("expected_net_value")).first()[0] or 0.0

    winner, ids = "greedy order", staged(_greedy(narrow, limits), "ids")
    value = worth(ids)
    search, settled, bound = _Search(pruned, limits), 0.0, math.inf
    # With the budget alone and at most one row per customer, hulls give the best price at once.
    by_hull = limits.capacity is None and not limits.channels and limits.per_customer in (None, 1)
    if by_hull:
        own = pruned if limits.per_customer else pruned.withColumn("who", F.col("id").cast("string"))
        hull = merge_steps(hull_steps(own), limits.budget)
        search.bound = bound = hull.bound
        if hull.value > value:
            winner, ids, value = "hull steps", hull.ids, hull.value
    for _ in range(1 if by_hull else MOST_PLANS):
        if bound - value <= gap * max(abs(value), 1.0):
            break
        prices = [hull.price] if by_hull else search.look()
        value, better, proven, settled = _branched(search, prices, limits, value, gap)
        if better is not None:
            winner, ids = "branching", staged(better, "ids")
        bound = min(bound, proven)
    search.end()
    left = max(0.0, (bound - value) / max(abs(value), 1.0))
    proof = "proven within the gap" if left <= gap else "gap not closed"
    status = f"{proof}; plan by {winner}; {settled:.4f} of the rows settled by reduced cost"
    return _finished(ranked, ids, method, limits, status, bound=max(bound, value))


def plan_optimised(
    df: DataFrame, budget: float = 500_000, capacity=None, min_net: float = 0.0, channel_limits=None, per_customer=1, gap: float = GAP
) -> Plan:
    """Value-maximising choice: prices on the limits from the Lagrangian dual, then a feasible plan.

    The plan keeps every limit and is never worth less than the greedy one; the summary states how
    far at most it can be from the best (Fisher, Management Science 1981). Rows whose reduced value
    settles them are fixed by a pass over all rows; the few others are branched on. The search ends
    at ``gap``, or after ``MOST_PLANS`` rounds of passes.
    """
    limits = check_limits(budget, capacity, channel_limits, per_customer)
    return _optimise(df, limits, min_net, None, False, "optimised", gap)


def plan_action_assignment(
    df: DataFrame, budget: float = 500_000, capacity=None, min_net: float = 0.0, channel_limits=None,
    entity: list[str] | None = None, gap: float = GAP,
) -> Plan:
    """One row per feasible (entity, action); at most one action per entity is chosen.

    Under a budget alone this is a multiple-choice knapsack: the steps of the entities' convex hulls,
    taken by efficiency, give the best fractional plan, and rows near its last step are branched on.
    """
    limits = check_limits(budget, capacity, channel_limits, 1)
    return _optimise(df, limits, min_net, entity, True, "optimised_action_assignment", gap)


def plan_contacts(df: DataFrame, method: str = "optimised", **limits) -> Plan:
    chosen = {"greedy": plan_greedy, "optimised": plan_optimised}.get(method.lower().strip())
    if chosen is None:
        raise ValueError("method must be 'optimised' or 'greedy'")
    return chosen(df, **limits)


def plan_compare(df: DataFrame, **limits) -> DataFrame:
    """Greedy and optimised plans side by side."""
    plans = {"greedy": plan_greedy(df, **limits), "optimised": plan_optimised(df, **limits)}
    base = plans["greedy"].summary["expected_net_value"]
    rows = []
    for name, plan in plans.items():
        s = plan.summary
        gain = (s["expected_net_value"] - base) / abs(base) * 100 if name == "optimised" and base else None
        rows.append((name, s["contacts"], s["cost_used"], s["expected_recovery"], s["expected_net_value"], s["success"], s["gap"], gain))
    return df.sparkSession.createDataFrame(
        rows, "method string, contacts long, cost_used double, expected_recovery double, expected_net_value double, "
        "success boolean, gap double, gain_pct double")

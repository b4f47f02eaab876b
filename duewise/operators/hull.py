"""One action per entity under one budget: convex hulls of cost and value, merged by efficiency.

Of an entity's actions only those on the upper convex hull of its points (cost, value), seen from
doing nothing at (0, 0), can be worth their cost at some price of the budget. Walking a hull is a
series of steps of falling efficiency, so the best fractional plan takes the steps of all entities in
the order of efficiency until the budget is used up (Sinha and Zoltners, Operations Research 1979).
The step that no longer fits gives the budget's price, the fractional plan the upper bound, and the
plan without that step lies below the bound by less than this one step.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duewise.operators.ordering import running
from duewise.session import staged

PIECES = 32  # an entity's rows are reduced to hulls in so many pieces first, so that none grows without bound
_POINT = "struct<cost:double,value:double,id:bigint,slope:double>"


def _hull(points: Column) -> Column:
    """The hull's points behind the origin, from points sorted by cost (dearer and no better ones fall out).

    The points that stay in front of a new one are those reached more steeply than they are left
    for it. Slopes fall along a hull, so these are its beginning.
    """
    def slope(a: Column, b: Column) -> Column:
        run = b["cost"] - a["cost"]
        return F.when(run > 0, (b["value"] - a["value"]) / run).when(b["value"] > a["value"], float("inf")).otherwise(float("-inf"))

    origin = F.struct(F.lit(0.0).alias("cost"), F.lit(0.0).alias("value"), F.lit(None).cast("bigint").alias("id"), F.lit(float("inf")).alias("slope"))

    def add(hull: Column, p: Column) -> Column:
        kept = F.filter(hull, lambda e: e["id"].isNull() | (e["slope"] > slope(e, p)))
        into = slope(F.element_at(kept, -1), p)
        point = F.struct(p["cost"].alias("cost"), p["value"].alias("value"), p["id"].alias("id"), into.alias("slope"))
        return F.when(into > 0, F.concat(kept, F.array(point))).otherwise(hull)

    start = F.array(origin).cast(f"array<{_POINT}>")
    return F.slice(F.aggregate(points, start, add), 2, F.greatest(F.size(points), F.lit(1)))


def _hulls(rows: DataFrame, *by: str) -> DataFrame:
    point = F.struct(F.col("cost"), (-F.col("value")).alias("less"), F.col("id"), F.col("value"))
    gathered = rows.groupBy(*by).agg(F.array_sort(F.collect_list(point)).alias("points"))
    return gathered.select(*by, F.explode(_hull(F.col("points"))).alias("p")).select(*by, "p.*")


def hull_steps(rows: DataFrame) -> DataFrame:
    """who, step, id, cost, value, efficiency, extra_cost and extra_value of every step of every hull.

    ``rows`` has who, id, action_cost and expected_net_value. Of rows with equal cost the most
    valuable counts, of those the one with the least id.
    """
    points = rows.where(F.col("expected_net_value") > 0).select(
        "who", "id", F.col("action_cost").cast("double").alias("cost"), F.col("expected_net_value").cast("double").alias("value")
    )
    pieces = points.withColumn("_piece", F.pmod(F.xxhash64("id"), F.lit(PIECES)))
    hulls = _hulls(_hulls(pieces, "who", "_piece").drop("slope"), "who")
    gathered = hulls.groupBy("who").agg(F.array_sort(F.collect_list(F.struct("cost", "value", "id", "slope"))).alias("hull"))
    walk = F.transform("hull", lambda p, k: F.struct(
        (k + 1).cast("int").alias("step"), p["id"].alias("id"), p["cost"].alias("cost"), p["value"].alias("value"), p["slope"].alias("efficiency"),
        (p["cost"] - F.when(k > 0, F.get(F.col("hull"), k - 1)["cost"]).otherwise(0.0)).alias("extra_cost"),
        (p["value"] - F.when(k > 0, F.get(F.col("hull"), k - 1)["value"]).otherwise(0.0)).alias("extra_value"),
    ))
    return gathered.select("who", F.explode(walk).alias("s")).select("who", "s.*")


@dataclass
class HullPlan:
    """The best fractional plan and the whole steps of it."""

    ids: DataFrame  # id of each entity's last whole step
    value: float  # of the whole steps
    bound: float  # of the fractional plan
    price: float  # of a unit of budget
    step_value: float  # of the step that did not fit, which the value lies below the bound at most


def merge_steps(steps: DataFrame, budget: float) -> HullPlan:
    """Take all steps by efficiency until one does not fit."""
    steps = staged(steps, "steps")
    ordered = running(
        steps, [F.col("efficiency").desc(), F.col("who"), F.col("step")],
        sums={"total_cost": F.col("extra_cost"), "total_value": F.col("extra_value")},
    )
    over = F.col("total_cost") > budget + 1e-9
    edge = ordered.where(over).agg(F.min_by(F.struct("position", "efficiency", "extra_cost", "extra_value", "total_cost", "total_value"), "position").alias("e")).first()["e"]
    if edge is None:
        whole, value, bound, price, left = ordered, None, None, 0.0, 0.0
    else:
        whole = ordered.where(F.col("position") < edge["position"])
        value = edge["total_value"] - edge["extra_value"]
        spare = budget - (edge["total_cost"] - edge["extra_cost"])
        bound, price, left = value + edge["efficiency"] * spare, edge["efficiency"], edge["extra_value"]
    ids = staged(whole.groupBy("who").agg(F.max_by("id", "step").alias("id")).select("id"), "hull-ids")
    if value is None:
        value = bound = float(ordered.agg(F.max_by("total_value", "position")).first()[0] or 0.0)
    return HullPlan(ids, float(value), float(bound), float(price), float(left))

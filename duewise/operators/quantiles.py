"""Exact quantiles by linear interpolation, without gathering or sorting all values.

An approximate pass puts a narrow bracket around each wanted rank. A second pass counts what lies
between brackets and lists only the values inside them, so the exact values can be read off.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duewise.operators.column_scans import POINTS, counts_in_zones, ranked_points
from duewise.operators.ordering import running
from duewise.session import staged

ACCURACY = 10_000  # the approximate pass is off by at most rows / ACCURACY ranks
LISTED_VALUES = 20_000  # distinct bracketed values that may reach the driver; more are ranked by partitions
WIDENINGS = (1, 20, 400)  # how far brackets reach, in turn, should one miss its rank


def nth_largest(df: DataFrame, columns: dict[str, Column], places: list[int], rows: int) -> dict[str, list[float]]:
    """The values at the 1-based ``places`` from the top of each column, none of which may hold nulls; ``rows`` is their number."""
    wanted = {n: (rows - n) / max(1, rows - 1) for n in places}
    found = exact_quantiles(df, columns, {c: sorted(set(wanted.values())) for c in columns}, rows)
    return {c: [found[c][wanted[n]] for n in places] for c in columns}


def lower_medians(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    """The value at rank ceil(n / 2) of each column's n numbers, None without one. Reads ``df`` twice, and counts it."""
    rows, kept = df.count(), {c: F.col(c) for c in columns}
    points = staged(ranked_points(df, kept, max(1, rows // POINTS)), "points")
    counts = {r["column"]: r["n"] for r in points.groupBy("column").agg(F.sum("n").alias("n")).collect()}  # one row per column
    wanted = {c: [((n - 1) // 2) / max(1, n - 1)] if (n := counts.get(c, 0)) else [0.5] for c in columns}
    found = exact_quantiles(df, kept, wanted, rows, points=points)
    return {c: found[c][wanted[c][0]] for c in columns}


class BracketMissed(ArithmeticError):
    """The approximate pass was further off than its bracket; a wider one is tried."""


WHOLE = 1e-7  # a wanted place this near a rank is that rank


@dataclass
class _Zone:
    """Values in [low, high] are listed; values below the next zone's start are only counted."""

    low: float
    high: float


def exact_quantiles(
    df: DataFrame,
    columns: dict[str, Column],
    probabilities: dict[str, list[float]],
    rows: int | None = None,
    listed_values: int = LISTED_VALUES,
    *,
    points: DataFrame | None = None,
) -> dict[str, dict[float, float | None]]:
    """Quantiles of several columns as driver-side scalars; None where a column has no value.

    Give a scan or a staged table: it is read twice, and a third time for a column whose brackets hold
    more distinct values than may be listed, which is then ranked by range partitioning. ``points`` are the
    columns' ``ranked_points``, where they are known already.
    """
    frame = df.select(*[present_number(c.cast("double")).alias(n) for n, c in columns.items()])
    rows = frame.count() if rows is None else rows
    # Arrow functions alone read long columns, and see to NaN and minus zero themselves.
    read = df.select(*[c.cast("double").alias(n) for n, c in columns.items()]) if rows > POINTS else frame
    for widening in WIDENINGS:
        try:
            return _quantiles(read, probabilities, rows, listed_values, widening, points)
        except BracketMissed:
            continue
    # Not reached in practice: everything is one bracket, ranked by range partitioning.
    return {n: _ranked(_placed(frame, n, [_Zone(-math.inf, math.inf)]), probabilities[n]) for n in columns}


SKETCH_SIZE = 8_000  # a sketch is off by about 1 / 2,700 of the rows, with brackets twice as far
SKETCH_REACH = 0.0008


def sketched_edges(value: Column, probabilities: list[float], widening: int = 1) -> Column:
    """Aggregate: a value safely below and one above each quantile, from one mergeable sketch; null without values."""
    edges = [min(1.0, max(0.0, q + side * widening * SKETCH_REACH)) for q in probabilities for side in (-1, 1)]
    sketch = F.call_function("kll_sketch_agg_double", value, F.lit(SKETCH_SIZE))
    found = F.call_function("kll_sketch_get_quantile_double", sketch, F.array(*[F.lit(e) for e in edges]))
    return F.when(F.count(value) > 0, found)


def zones_of(edges: list[tuple[float, float]]) -> list[_Zone]:
    """Brackets in rising order; those that meet are one."""
    out: list[_Zone] = []
    for low, high in sorted(edges):
        if out and low <= out[-1].high:
            out[-1].high = max(high, out[-1].high)
        else:
            out.append(_Zone(low, high))
    return out


def zone_of(zones: list[_Zone], value: float) -> int:
    for k, z in enumerate(zones):
        if z.low <= value <= z.high:
            return 2 * k + 1
    raise BracketMissed("a fence fell outside its bracket")


def beyond(steps: list[tuple], zones: list[_Zone], low: float, high: float) -> int:
    """How many values lie below ``low`` or above ``high``, both of which lie within brackets."""
    first, last = zone_of(zones, low), zone_of(zones, high)
    below = sum(n for zone, value, n in steps if zone < first or (zone == first and value < low))
    return below + sum(n for zone, value, n in steps if zone > last or (zone == last and value > high))


def grouped_quantiles(
    df: DataFrame, by: str, value: str, probabilities: list[float], listed_values: int = LISTED_VALUES
) -> DataFrame:
    """``by``, probability, value: exact quantiles of each group, a null group included.

    As for whole columns: an approximate pass brackets the wanted ranks of every group, a second one
    counts each group's rows between brackets and its distinct values within them, in one shuffle that
    adds up inside tasks. No group is gathered. Where the listed values are few they are read off on the
    driver, else ranked by range partitioning; both give the same. Groups without a value are left out.
    """
    spark = df.sparkSession
    frame = df.select(F.col(by), present_number(F.col(value).cast("double")).alias("_v")).where(F.col("_v").isNotNull())
    kind = df.schema[by].dataType
    wanted = sorted(set(probabilities))
    for widening in (*WIDENINGS, None):
        counts = _group_counts(frame, by, wanted, widening)
        found = counts.limit(listed_values + 1).collect()
        try:
            if len(found) <= listed_values:
                steps: dict = {}
                for r in found:
                    steps.setdefault(r[by], []).append((r["zone"], r["value"], r["n"]))
                rows = [
                    (group, q, v) for group, mine in steps.items()
                    for q, v in read_off(sorted(mine, key=lambda s: (s[0], s[1] or 0.0)), wanted).items()
                ]
                schema = T.StructType([T.StructField(by, kind), T.StructField("probability", T.DoubleType()), T.StructField("value", T.DoubleType())])
                return spark.createDataFrame(rows, schema)
            return _grouped_ranks(staged(counts, "group-counts"), by, wanted)
        except BracketMissed:
            continue
    raise BracketMissed(value)


def _group_counts(frame: DataFrame, by: str, probabilities: list[float], widening: int | None) -> DataFrame:
    """Rows per group, zone and listed value. Without ``widening`` every value is listed."""
    if widening is None:
        return frame.groupBy(by, F.lit(1).alias("zone"), F.col("_v").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    edges = [min(1.0, max(0.0, q + side * widening * 3.0 / ACCURACY)) for q in probabilities for side in (-1, 1)]
    brackets = frame.groupBy(F.col(by).alias("_by")).agg(F.percentile_approx("_v", edges, ACCURACY).alias("_edges"))
    inside, zone = F.lit(False), F.lit(0)
    for k in range(len(probabilities)):
        low, high = F.col("_edges")[2 * k], F.col("_edges")[2 * k + 1]
        inside = inside | F.col("_v").between(low, high)
        zone = zone + (F.col("_v") > high).cast("int")
    # Values of overlapping brackets are listed once; zones rise with the values.
    placed = frame.join(brackets, F.col(by).eqNullSafe(F.col("_by"))).select(
        by, F.when(inside, F.col("_v")).alias("value"), (2 * zone + inside.cast("int")).alias("zone")
    )
    return placed.groupBy(by, "zone", "value").agg(F.count(F.lit(1)).alias("n"))


def ranked_columns(counts: DataFrame, probabilities: dict[str, list[float]]) -> dict[str, dict[float, float | None]]:
    """Quantiles from staged counts (name, zone, value, n) of all columns at once, ranked by range partitioning."""
    out: dict = {n: dict.fromkeys(qs) for n, qs in probabilities.items()}
    for r in _grouped_ranks(counts, "name", probabilities).collect():  # a row per column and probability
        out[r["name"]][r["probability"]] = r["value"]
    return out


def _grouped_ranks(counts: DataFrame, by: str, probabilities: list[float] | dict[str, list[float]]) -> DataFrame:
    """Values at the wanted ranks of each group; ``probabilities`` are the same for all, or a group's own."""
    ranked = staged(running(counts, [F.col("zone"), F.col("value")], by=[by], sums={"upto": F.col("n")}), "group-ranks")
    totals = ranked.groupBy(F.col(by).alias("_by")).agg(F.max("upto").alias("total"))
    if isinstance(probabilities, dict):
        pairs = counts.sparkSession.createDataFrame([(g, q) for g, qs in probabilities.items() for q in set(qs)], "_by string, probability double")
        wanted = totals.join(F.broadcast(pairs), "_by")
    else:
        wanted = totals.select("_by", "total", F.explode(F.array(*[F.lit(q) for q in probabilities])).alias("probability"))
    spot = F.col("probability") * (F.col("total") - 1)
    # A wanted place next to a rank is that rank, as in ``read_off``.
    near = F.abs(spot - F.round(spot)) < WHOLE
    wanted = wanted.select("_by", "probability", F.when(near, F.round(spot)).otherwise(spot).alias("spot"))
    below, above = F.floor("spot"), F.ceil("spot")
    # Each wanted rank lies in one row of its group.
    hit = ranked.join(wanted, F.col(by).eqNullSafe(F.col("_by"))).where(
        ((below < F.col("upto")) & (below >= F.col("upto") - F.col("n"))) | ((above < F.col("upto")) & (above >= F.col("upto") - F.col("n")))
    )
    low = F.max(F.when((below < F.col("upto")) & (below >= F.col("upto") - F.col("n")), F.col("value")))
    high = F.max(F.when((above < F.col("upto")) & (above >= F.col("upto") - F.col("n")), F.col("value")))
    part = F.max("spot") - F.floor(F.max("spot"))
    out = hit.groupBy(by, "probability").agg(low.alias("low"), high.alias("high"), part.alias("part"))
    if out.where(F.col("low").isNull() | F.col("high").isNull()).limit(1).count():
        raise BracketMissed("a wanted rank fell outside its bracket")
    value = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.col("low") + (F.col("high") - F.col("low")) * F.col("part"))
    return out.select(by, "probability", value.alias("value"))


def present_number(value: Column) -> Column:
    """NaN counts as missing, and minus zero as zero."""
    return F.when(~F.isnan(value), value + F.lit(0.0))


def _quantiles(
    frame: DataFrame, probabilities: dict[str, list[float]], rows: int, listed_values: int, widening: int, points: DataFrame | None = None
):
    columns = frame.columns
    zones = _brackets(frame, probabilities, rows, widening, **({} if points is None else {"points": points}))
    counted = zone_counts(frame, zones)
    # Of long columns the values may be too many to list, and are not counted twice for that.
    counted = staged(counted, "zone-counts") if rows > POINTS else counted
    found = counted.limit(listed_values + 1).collect()
    if len(found) > listed_values:
        return ranked_columns(counted if rows > POINTS else staged(counted, "zone-counts"), probabilities)
    steps: dict[str, list] = {n: [] for n in columns}
    for r in found:
        steps[r["name"]].append((r["zone"], r["value"], r["n"]))
    return {n: read_off(sorted(steps[n], key=lambda s: (s[0], s[1] or 0.0)), probabilities[n]) for n in columns}


def _brackets(
    frame: DataFrame, probabilities: dict[str, list[float]], rows: int, widening: int = 1, points: DataFrame | None = None
) -> dict[str, list[_Zone]]:
    reach = widening * (3.0 / ACCURACY + 2.0 / max(rows, 1))
    wanted = {
        n: [min(1.0, max(0.0, q + side * reach)) for q in sorted(qs) for side in (-1, 1)] for n, qs in probabilities.items()
    }
    if rows > POINTS:  # the points of long columns stand for their values; one group per column
        points = staged(ranked_points(frame, {n: F.col(n) for n in wanted}, rows // POINTS), "points") if points is None else points
        sizes = points.groupBy("column").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("pieces")).collect()
        for r in sizes:  # each piece's points are off by chance, which weighs more the fewer values a column has
            off = 2.0 * widening * (rows // POINTS) * math.sqrt(r["pieces"]) / max(1, r["n"])
            wanted[r["column"]] = [
                min(1.0, max(0.0, q + side * max(reach, 1.0 / ACCURACY + off))) for q in sorted(probabilities[r["column"]]) for side in (-1, 1)]
        points = points.select("column", F.explode("points").alias("v"))
        at = sorted({q for qs in wanted.values() for q in qs})
        edges = points.groupBy("column").agg(F.percentile_approx("v", at, ACCURACY).alias("v")).collect()
        found = dict.fromkeys(wanted) | {r["column"]: [r["v"][at.index(q)] for q in wanted[r["column"]]] for r in edges}
    else:
        found = frame.agg(*[F.percentile_approx(n, qs, ACCURACY).alias(n) for n, qs in wanted.items()]).first()
    out: dict[str, list[_Zone]] = {}
    for n in wanted:
        zones: list[_Zone] = []
        values = found[n] or []
        for low, high in zip(values[::2], values[1::2]):
            if zones and low <= zones[-1].high:
                zones[-1].high = max(high, zones[-1].high)
            else:
                zones.append(_Zone(low, high))
        out[n] = zones
    return out


def _placed(frame: DataFrame, name: str, zones: list[_Zone]) -> DataFrame:
    """(zone, value if listed) of one column: odd zones are brackets, even ones lie between them."""
    value, zone = F.col(name), F
    for i, z in enumerate(zones):
        zone = zone.when(value < z.low, 2 * i).when(value <= z.high, 2 * i + 1)
    zone = (zone.otherwise(2 * len(zones)) if zones else F.lit(0)).cast("int")
    return frame.where(value.isNotNull()).select(zone.alias("zone"), F.when(zone % 2 == 1, value).alias("value"))


def zone_counts(frame: DataFrame, zones: dict[str, list[_Zone]]) -> DataFrame:
    """Rows per column, zone and listed value, from one scan; rows collapse within each task."""
    return counts_in_zones(frame, {n: F.col(n) for n in zones}, {n: [(z.low, z.high) for z in zs] for n, zs in zones.items()})


def read_off(steps: list[tuple], probabilities: list[float]) -> dict[float, float | None]:
    """Values at the wanted ranks, from counts in rising order."""
    total = sum(n for *_, n in steps)
    if total == 0:
        return {q: None for q in probabilities}

    def at(rank: int) -> float:
        upto = 0
        for _, value, n in steps:
            upto += n
            if rank < upto:
                if value is None:
                    raise BracketMissed("a wanted rank fell outside its bracket")
                return value
        raise IndexError(rank)

    out = {}
    for q in probabilities:
        spot = q * (total - 1)
        spot = round(spot) if abs(spot - round(spot)) < WHOLE else spot
        low, high = at(math.floor(spot)), at(math.ceil(spot))
        out[q] = low if low == high else low + (high - low) * (spot - math.floor(spot))
    return out


def _ranked(placed: DataFrame, probabilities: list[float]) -> dict[float, float | None]:
    """The same with bracketed values ranked by range partitioning instead of listed."""
    counts = placed.groupBy("zone", "value").agg(F.count(F.lit(1)).alias("n"))
    ranked = running(counts, [F.col("zone").asc(), F.col("value").asc()], sums={"upto": F.col("n")})
    total = ranked.agg(F.max("upto")).first()[0] or 0
    if total == 0:
        return {q: None for q in probabilities}
    spots = [q * (total - 1) for q in probabilities]
    ranks = sorted({k for s in spots for k in (math.floor(s), math.ceil(s))})
    # Each rank lies in exactly one row: at most two rows per probability come back.
    hit = ranked.where(" OR ".join(f"({k} < upto AND {k} >= upto - n)" for k in ranks)).orderBy("upto").collect()
    previous, steps = 0, []
    for r in hit:
        start = r["upto"] - r["n"]
        if start > previous:
            steps.append((r["zone"], None, start - previous))
        steps.append((r["zone"], r["value"], r["n"]))
        previous = r["upto"]
    steps.append((None, None, total - previous))
    return read_off(steps, probabilities)

"""Economic back-test of rankings against simple rules and random order."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duewise import fixed_values as V
from duewise.functions.expressions import clip, fill_zero
from duewise.operators.decision import tie_breakers
from duewise.operators.ordering import running
from duewise.operators.quantiles import nth_largest
from duewise.session import staged

STRATEGIES = {
    V.STRATEGY_AMOUNT: "amount_due",
    V.STRATEGY_DPD: "days_past_due",
    V.STRATEGY_P: "p_cure",
    V.STRATEGY_RECOVERY: "expected_recovery",
    V.STRATEGY_NET: "expected_net_value",
}
RANDOM_ORDER = "random"
_RATIO = F.try_divide


def _or_zero(df: DataFrame, name: str) -> Column:
    return fill_zero(F.col(name).cast("double")) if name in df.columns else F.lit(0.0)


def _outcomes(df: DataFrame) -> list[Column]:
    return [
        clip(_or_zero(df, "recovered_in_horizon"), low=0.0).alias("_recovery"),
        _or_zero(df, "cured_in_horizon").alias("_success"),
        _or_zero(df, "action_cost").alias("_cost"),
    ]


def _overall(df: DataFrame) -> tuple[int, float, float]:
    row = df.select(*_outcomes(df)).agg(F.count(F.lit(1)), F.sum("_recovery"), F.avg("_success")).first()
    return row[0], row[1] or 0.0, row[2] or 0.0


def top_n(rows: int, fraction: float) -> int:
    return max(1, math.ceil(rows * fraction))


def _top_sums(narrow: DataFrame, strategies: list[str], ties: list[Column], sizes: list[int], rows: int) -> DataFrame:
    """strategy, place in ``sizes``, and the outcomes' sums over its best rows.

    The n-th best score is selected from brackets, rows above it are added up by condition, and only
    rows of exactly that score are ranked.
    """
    cuts = nth_largest(narrow, {f"s{k}": F.col(f"_score_{k}") for k in range(len(strategies))}, sizes, rows)
    spots = [(k, i, cuts[f"s{k}"][i]) for k in range(len(strategies)) for i in range(len(sizes))]
    measures = ("_recovery", "_success", "_cost")
    above = narrow.agg(*[
        agg for k, i, cut in spots for above in (F.col(f"_score_{k}") > cut,)
        for agg in (F.count_if(above).alias(f"_n_{k}_{i}"), *[F.sum(F.when(above, F.col(m))).alias(f"{m}_{k}_{i}") for m in measures])
    ]).first()
    room = {(k, i): sizes[i] - above[f"_n_{k}_{i}"] for k, i, _ in spots}
    at_cut = F.array_compact(F.array(*[
        F.when(F.col(f"_score_{k}") == cut, F.struct(F.lit(k).alias("_k"), F.lit(i).alias("_i"), F.lit(room[k, i]).cast("long").alias("_room")))
        for k, i, cut in spots
    ]))
    tied = staged(narrow.select(*[c for c in narrow.columns if not c.startswith("_score_")], F.explode(at_cut).alias("_c")).select("*", "_c.*").drop("_c"), "tied")
    ranked = running(tied, ties, by=["_k", "_i"]).where(F.col("position") <= F.col("_room"))
    rest = ranked.groupBy("_k", "_i").agg(*[F.sum(m).alias(m) for m in measures])
    known = narrow.sparkSession.createDataFrame(
        [(k, i, strategies[k], *[float(above[f"{m}_{k}_{i}"] or 0.0) for m in measures]) for k, i, _ in spots],
        "_k int, _i int, strategy string, " + ", ".join(f"_above{m} double" for m in measures),
    )
    return known.join(rest, ["_k", "_i"], "left").select(
        "strategy", F.col("_i").alias("place"), *[(F.col(f"_above{m}") + F.coalesce(F.col(m), F.lit(0.0))).alias(m) for m in measures]
    )


def strategy_benchmark(df: DataFrame, fractions: tuple = V.TOP_FRACTIONS) -> DataFrame:
    """Outcome of contacting the top fraction under each deterministic ranking. No ranking is sorted."""
    rows, total, base = _overall(df)
    if rows == 0:
        fractions = ()
    ties = [c for c in ("customer_id", "credit_id", "relative_due_day", "instalment_no", "amount_due") if c in df.columns]
    narrow = staged(df.select(
        *[F.col(c).alias(f"_tie_{c}") for c in ties], *_outcomes(df), *[_or_zero(df, c).alias(f"_score_{k}") for k, c in enumerate(STRATEGIES.values())],
    ), "ranked-by")
    sizes = {f: top_n(rows, f) for f in fractions}
    strategies = list(STRATEGIES)
    order = [F.col(f"_tie_{c}").asc_nulls_last() for c in ties]
    sums = _top_sums(narrow, strategies, order, list(sizes.values()), rows) if rows else None
    if sums is None:
        sums = df.sparkSession.createDataFrame([], "strategy string, place int, _recovery double, _success double, _cost double")
    shares = df.sparkSession.createDataFrame(
        [(i, float(f), int(n)) for i, (f, n) in enumerate(sizes.items())], "place int, top_pct double, contacted long")
    per_fraction = sums.join(F.broadcast(shares), "place").drop("place")
    rate = F.col("_success") / F.col("contacted")
    return per_fraction.select(
        "strategy",
        F.lit(V.STRATEGY_KIND).alias("strategy_kind"),
        "top_pct",
        "contacted",
        rate.alias("success_rate"),
        F.lit(base).alias("base_rate"),
        F.when(F.lit(base) > 0, _RATIO(rate, F.lit(base))).alias("lift"),
        F.col("_recovery").alias("observed_recovery"),
        (_RATIO(F.col("_recovery"), F.lit(total)) if total > 0 else F.lit(0.0)).alias("capture"),
        F.col("_cost").alias("cost"),
        (F.col("_recovery") - F.col("_cost")).alias("observed_net"),
    )


def top_fraction(df: DataFrame, fraction: float, strategy: str = V.STRATEGY_NET) -> DataFrame:
    """The rows that the strategy contacts first, with their position; at least one."""
    rows = df.count()
    ranked = running(df, [_strategy_score(df, strategy).desc(), *tie_breakers(df)])
    return ranked.where(F.col("position") <= top_n(rows, fraction))


def _strategy_score(df: DataFrame, strategy: str) -> Column:
    """What a strategy sorts by, best first; the random one by a hash of the row's draw key."""
    return F.xxhash64(draw_key(df)).cast("double") if strategy == RANDOM_ORDER else _or_zero(df, STRATEGIES[strategy])


def draw_key(df: DataFrame) -> Column:
    """Text that identifies a row in a random draw; rows with the same text have the same outcome.

    Amounts go in as whole cents, which print alike everywhere.
    """
    def cents(name: str) -> Column:
        return F.floor(_or_zero(df, name) * 100 + 0.5).cast("long").cast("string")

    keys = [c for c in ("credit_id", "relative_due_day", "instalment_no") if c in df.columns]
    return F.concat_ws(
        "|",
        *[F.coalesce(F.col(c).cast("long").cast("string"), F.lit("null")) for c in keys],
        cents("amount_due"), cents("recovered_in_horizon"), cents("cured_in_horizon"), cents("action_cost"),
    )


_PRIME = 2_147_483_647  # 2^31 - 1: products of two smaller numbers fit a long, and so does their sum


def draw_factors(simulation: int) -> tuple[int, int]:
    """The two pseudo-random factors of a draw."""
    return tuple(int(hashlib.md5(f"{side}{simulation}".encode()).hexdigest()[:8], 16) % _PRIME for side in "ab")


def _range_sums(factors: dict[int, tuple[int, int]], width: int, measures: tuple):
    """Rows and sums per draw and range of the mix, from one array per task."""
    prime, ranges = _PRIME, _PRIME // width + 1

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(factors), 1 + len(measures), ranges))
        for batch in batches:
            x, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_x", "_y"))
            values = [batch.column(m).to_numpy(zero_copy_only=False) for m in measures]
            for k, (a, b) in enumerate(factors.values()):
                at = (x * a + y * b) % prime // width
                total[k, 0] += np.bincount(at, minlength=ranges)
                for j, v in enumerate(values, 1):
                    total[k, j] += np.bincount(at, v, minlength=ranges)
        draw, where = np.nonzero(total[:, 0])
        names = np.array(list(factors))
        yield pa.RecordBatch.from_arrays(
            [pa.array(names[draw].astype(np.int32)), pa.array(where.astype(np.int32)), pa.array(total[draw, 0, where].astype(np.int64)),
             *[pa.array(total[draw, j, where]) for j in range(1, 1 + len(measures))]],
            names=["sim", "_range", "_n", *measures],
        )

    return added


def _range_rows(factors: dict[int, tuple[int, int]], width: int, edges: dict[int, list[int]]):
    """The rows that a draw puts into one of its ``edges``, with their mix."""
    prime, ranges = _PRIME, _PRIME // width + 1

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = {}
        for sim, these in edges.items():
            wanted[sim] = np.zeros(ranges, bool)
            wanted[sim][these] = True
        for batch in batches:
            x, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_x", "_y"))
            rest = batch.select([c for c in batch.schema.names if c not in ("_x", "_y")])
            for sim, mask in wanted.items():
                a, b = factors[sim]
                mix = (x * a + y * b) % prime
                rows = np.flatnonzero(mask[mix // width])
                if len(rows):
                    part = rest.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), sim, np.int32)), pa.array((mix[rows] // width).astype(np.int32)), pa.array(mix[rows]), *part.columns],
                        names=["sim", "_range", "_mix", *part.schema.names],
                    )

    return chosen


def random_benchmark(df: DataFrame, fractions: tuple = V.TOP_FRACTIONS, simulations: int = 200) -> DataFrame:
    """Mean and spread of random contact lists, drawn without replacement.

    A row is hashed once; a draw orders rows by a random linear mix of the two halves of that hash, and
    its top n is the list. No draw is sorted, and no row is repeated per draw: each task adds up its
    rows in one array of draws x ranges of the mix. The sums locate the range the n-th row lies in,
    ranges before it count whole, and only rows of that range are looked at one by one.
    """
    rows, total, base = _overall(df)
    if rows == 0:
        raise ValueError("no rows to draw from")
    simulations = max(1, simulations)
    width = 2**23 if rows <= 1_000_000 else 2**19  # 256 or 4,096 ranges
    sizes = {f: top_n(rows, f) for f in fractions}
    measures = ("_recovery", "_success", "_cost")

    def half(start: int) -> Column:
        return F.conv(F.substring(F.md5("_key"), start, 8), 16, 10).cast("long") % _PRIME

    factors = {n: draw_factors(n) for n in range(1, simulations + 1)}
    keyed = df.select(draw_key(df).alias("_key"), *_outcomes(df))
    keyed = keyed.select("*", half(1).alias("_x"), half(9).alias("_y"))
    sums = ["_n", *measures]

    # simulations x ranges rows, however many rows the data has.
    per_task = keyed.select("_x", "_y", *measures).mapInArrow(
        _range_sums(factors, width, measures), "sim int, _range int, _n long, " + ", ".join(f"{m} double" for m in measures))
    ranges = staged(per_task.groupBy("sim", "_range").agg(*[F.sum(c).alias(c) for c in sums]), "draws")
    before = Window.partitionBy("sim").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    so_far = ranges.select(
        "sim", "_range", "_n",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n_before"),
        *[F.coalesce(F.sum(m).over(before), F.lit(0.0)).alias(f"{m}_before") for m in measures],
    )
    # A second select: an explode beside the windows would repeat rows before they are added up.
    so_far = so_far.withColumn("_f", F.explode(F.array(*[
        F.struct(F.lit(f).alias("top_pct"), F.lit(n).cast("long").alias("contacted")) for f, n in sizes.items()
    ]))).select("*", "_f.*").drop("_f")
    # One row per simulation and fraction: the range that holds the n-th row.
    edge = so_far.where(
        (F.col("_n_before") < F.col("contacted")) & (F.col("_n_before") + F.col("_n") >= F.col("contacted"))
    )
    edge = staged(edge.drop("_n"), "edge")

    edges: dict[int, list[int]] = {}
    for r in edge.select("sim", "_range").distinct().collect():  # a row per simulation and fraction at most
        edges.setdefault(r["sim"], []).append(r["_range"])
    rows_there = keyed.mapInArrow(
        _range_rows(factors, width, edges), "sim int, _range int, _mix long, _key string, " + ", ".join(f"{m} double" for m in measures))
    fine = rows_there.groupBy("sim", "_range", "_mix", "_key").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(m).alias(m) for m in measures])
    inside = Window.partitionBy("sim", "_range").orderBy("_mix", "_key").rowsBetween(Window.unboundedPreceding, -1)
    fine = fine.withColumn("_earlier", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    joined = edge.join(fine.withColumnsRenamed({m: f"{m}_fine" for m in measures}), ["sim", "_range"])
    wanted = F.col("contacted") - F.col("_n_before") - F.col("_earlier")
    share = F.when(wanted >= F.col("_n"), F.lit(1.0)).when(wanted > 0, wanted / F.col("_n")).otherwise(0.0)
    per_draw = joined.groupBy("sim", "top_pct", "contacted").agg(*[
        (F.max(f"{m}_before") + F.sum(F.col(f"{m}_fine") * share)).alias(m) for m in measures
    ])
    per_draw = per_draw.withColumn("_net", F.col("_recovery") - F.col("_cost"))
    # `simulations` values per fraction.
    stats = per_draw.groupBy("top_pct", "contacted").agg(
        F.avg(F.col("_success") / F.col("contacted")).alias("success_rate"),
        *[F.avg(m).alias(m) for m in ("_recovery", "_cost", "_net")],
        F.percentile("_recovery", F.lit(0.1)).alias("random_recovery_p10"),
        F.percentile("_recovery", F.lit(0.9)).alias("random_recovery_p90"),
        F.percentile("_net", F.lit(0.1)).alias("random_net_p10"),
        F.percentile("_net", F.lit(0.9)).alias("random_net_p90"),
    )
    return stats.select(
        F.lit(f"Aleatorio promedio ({simulations} sims)").alias("strategy"),
        F.lit(V.RANDOM_KIND).alias("strategy_kind"),
        "top_pct",
        "contacted",
        "success_rate",
        F.lit(base).alias("base_rate"),
        F.when(F.lit(base) > 0, _RATIO(F.col("success_rate"), F.lit(base))).alias("lift"),
        F.col("_recovery").alias("observed_recovery"),
        (_RATIO(F.col("_recovery"), F.lit(total)) if total > 0 else F.lit(0.0)).alias("capture"),
        F.col("_cost").alias("cost"),
        F.col("_net").alias("observed_net"),
        "random_recovery_p10", "random_recovery_p90", "random_net_p10", "random_net_p90",
    )


def benchmark_compare(deterministic: DataFrame, random: DataFrame) -> DataFrame:
    """Both benchmarks in one table, with each row set against the model and the random draws."""
    both = random.unionByName(deterministic, allowMissingColumns=True)
    same = Window.partitionBy("top_pct")  # a handful of strategies per fraction

    def of(condition: Column, name: str) -> Column:
        return F.max(F.when(condition, F.col(name))).over(same)

    is_model, is_random = F.col("strategy") == V.STRATEGY_NET, F.col("strategy_kind") == V.RANDOM_KIND
    observed = F.col("observed_recovery")
    model, mean = of(is_model, "observed_recovery"), of(is_random, "observed_recovery")
    p90 = of(is_random, "random_recovery_p90")
    return both.select(
        "*",
        F.when(observed > 0, _RATIO(model, observed) - 1).alias("model_gain"),
        F.when(mean > 0, _RATIO(observed, mean)).alias("lift_vs_random"),
        F.coalesce(observed > p90, F.lit(False)).alias("beats_random_p90"),
    )


def full_benchmark(df: DataFrame, fractions: tuple = V.TOP_FRACTIONS, simulations: int = 200) -> DataFrame:
    out = benchmark_compare(strategy_benchmark(df, fractions), random_benchmark(df, fractions, simulations))
    return out.orderBy("top_pct", F.col("observed_recovery").desc(), "strategy")


def benchmark_slice(benchmark: DataFrame, top_pct: float) -> DataFrame:
    return benchmark.where(F.abs(F.col("top_pct") - top_pct) < 1e-9).orderBy(F.col("observed_recovery").desc(), "strategy")


def recovery_curve(df: DataFrame, strategy: str = V.STRATEGY_NET, step: float = 0.01) -> DataFrame:
    """Cumulative outcome at every ``step`` of rows contacted in the strategy's order, up to all.

    ``strategy`` is a deterministic one or ``RANDOM_ORDER``. A step is a part of 1 that divides it.
    """
    parts = round(1 / step)
    if not 0 < step <= 1 or abs(parts * step - 1) > 1e-9:
        raise ValueError(f"step must divide 1 evenly: {step!r}")
    rows, total, _ = _overall(df)
    narrow = df.select(
        *[c for c in ("customer_id", "credit_id", "relative_due_day", "instalment_no", "amount_due") if c in df.columns],
        _strategy_score(df, strategy).alias("_score"), *_outcomes(df),
    )
    ranked = running(narrow, [F.col("_score").desc(), *tie_breakers(narrow)])
    # The first part whose list, the top ceil(rows * part / parts), holds this row.
    part = F.expr(f"CAST(((position - 1) * {parts}) DIV {max(rows, 1)} + 1 AS INT)")
    sums = ranked.groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(m).alias(m) for m in ("_recovery", "_success", "_cost")]
    )
    grid = df.sparkSession.range(1, parts + 1).select(F.col("id").cast("int").alias("part"))
    so_far = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # one row per step
    curve = grid.join(sums, "part", "left").select(
        "part", *[F.coalesce(F.sum(m).over(so_far), F.lit(0)).alias(m) for m in ("n", "_recovery", "_success", "_cost")]
    )
    return curve.select(
        F.lit(strategy).alias("strategy"),
        (F.col("part") / float(parts)).alias("contacted_pct"),
        F.col("n").alias("contacted"),
        F.col("_recovery").alias("cumulative_recovery"),
        (_RATIO(F.col("_recovery"), F.lit(total)) if total > 0 else F.lit(0.0)).alias("capture"),
        F.col("_cost").alias("cumulative_cost"),
        (F.col("_recovery") - F.col("_cost")).alias("observed_net"),
        _RATIO(F.col("_success"), F.col("n")).alias("cumulative_success_rate"),
    ).orderBy("contacted_pct")

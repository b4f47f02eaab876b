"""Instalment preparation, ordered history features and delinquency events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duewise import fixed_values as V
from duewise.functions.expressions import clip, fill_zero, flag, require_columns, safe_divide, to_number
from duewise.operators.ordering import FIND, HOT_ROWS, chunked, hot_keys, split_hot

INSTALMENT_COLUMNS = ("credit_id", "customer_id", "version", "number", "due_day", "pay_day", "instalment", "payment")


def instalment_order() -> list[Column]:
    """Oldest first. Day and number do not make the order total, so the rest breaks ties."""
    return [F.col(c).asc_nulls_last() for c in ("due_day", "number", "version", "pay_day", "instalment", "payment")]


def prepare_instalments(instalments: DataFrame) -> DataFrame:
    """Row-wise payment facts; a pure projection, so it costs no shuffle."""
    require_columns(instalments, INSTALMENT_COLUMNS, "instalments")
    typed = instalments.select(
        "credit_id",
        "customer_id",
        to_number(F.col("version")).alias("version"),
        to_number(F.col("number")).cast("int").alias("number"),
        to_number(F.col("due_day")).cast("int").alias("due_day"),
        to_number(F.col("pay_day")).cast("int").alias("pay_day"),
        fill_zero(to_number(F.col("instalment"))).alias("instalment"),
        fill_zero(to_number(F.col("payment"))).alias("payment"),
    )
    gap = F.col("pay_day") - F.col("due_day")
    short = F.col("instalment") - F.col("payment")
    facts = typed.select(
        "*",
        clip(gap, low=0).alias("days_past_due"),
        clip(F.col("due_day") - F.col("pay_day"), low=0).alias("days_before_due"),
        clip(safe_divide(F.col("payment"), F.col("instalment")), 0.0, V.MAX_RATIO).alias("payment_ratio"),
        clip(short, low=0.0).alias("unpaid_amount"),
        clip(F.col("payment") - F.col("instalment"), low=0.0).alias("overpay_amount"),
    )
    return facts.select(
        "*",
        flag(F.col("days_past_due") > 0).alias("is_late"),
        flag(F.col("payment_ratio") < V.FULL_PAYMENT_RATIO).alias("is_partial"),
        flag(F.col("payment_ratio") >= V.FULL_PAYMENT_RATIO).alias("is_full"),
        (F.coalesce(F.col("days_past_due"), F.lit(0)) * F.col("instalment")).alias("severity"),
    )


# Running measures a history needs: name -> value of one row.
_RUNNING_SUMS = {
    "dpd": lambda: F.coalesce(F.col("days_past_due"), F.lit(0)).cast("double"),
    "dpd_sq": lambda: F.pow(F.coalesce(F.col("days_past_due"), F.lit(0)).cast("double"), 2.0),
    "late": lambda: F.col("is_late"),
    "partial": lambda: F.col("is_partial"),
    "full": lambda: F.col("is_full"),
    "ratio": lambda: F.col("payment_ratio"),
    "unpaid": lambda: F.col("unpaid_amount"),
    "severity": lambda: F.col("severity"),
    "payment": lambda: F.col("payment"),
    "instalment": lambda: F.col("instalment"),
}


def _recent(window: Window) -> dict[str, Column]:
    """Previous row and the last 3 and 6 rows; these frames look at most 6 rows back."""
    last = {
        "last_dpd": "days_past_due", "last_ratio": "payment_ratio",
        "last_late": "is_late", "last_partial": "is_partial",
    }
    out = {name: F.lag(c, 1).over(window) for name, c in last.items()}
    for width in (3, 6):
        frame = window.rowsBetween(-width, -1)
        out |= {
            f"roll{width}_dpd_mean": F.avg("days_past_due").over(frame),
            f"roll{width}_dpd_max": F.max("days_past_due").over(frame),
            f"roll{width}_late_rate": F.avg("is_late").over(frame),
            f"roll{width}_partial_rate": F.avg("is_partial").over(frame),
            f"roll{width}_ratio_mean": F.avg("payment_ratio").over(frame),
            f"roll{width}_unpaid_sum": F.sum("unpaid_amount").over(frame),
            f"roll{width}_severity_sum": F.sum("severity").over(frame),
        }
    return out


def _from_totals(df: DataFrame) -> DataFrame:
    """Turn running sums before a row (``_s_*``, ``_n``) into the named features."""
    n = F.col("_n").cast("double")
    mean = {k: F.try_divide(F.col(f"_s_{k}").cast("double"), n) for k in ("dpd", "late", "partial", "full", "ratio")}
    variance = F.try_divide(F.col("_s_dpd_sq"), n) - mean["dpd"] * mean["dpd"]
    helpers = ["_n", "_max_dpd", "_min_ratio", *[f"_s_{k}" for k in _RUNNING_SUMS]]
    return df.select(
        *[c for c in df.columns if c not in helpers],
        F.col("_n").cast("long").alias("hist_count"),
        mean["dpd"].alias("hist_dpd_mean"),
        # The running extreme is null where the row just before has no value.
        F.when(F.col("last_dpd").isNotNull(), F.col("_max_dpd")).alias("hist_dpd_max"),
        F.sqrt(clip(variance, low=0.0)).alias("hist_dpd_std"),
        mean["late"].alias("hist_late_rate"),
        mean["partial"].alias("hist_partial_rate"),
        mean["full"].alias("hist_full_rate"),
        mean["ratio"].alias("hist_ratio_mean"),
        F.when(F.col("last_ratio").isNotNull(), F.col("_min_ratio")).alias("hist_ratio_min"),
        *[F.col(f"_s_{k}").cast("double").alias(f"hist_{k}_sum") for k in ("unpaid", "severity", "payment", "instalment")],
    )


def _history_per_credit(prepared: DataFrame) -> DataFrame:
    """One shuffle and one sort on the credit; every frame shares them."""
    window = Window.partitionBy("credit_id").orderBy(*instalment_order())
    past = window.rowsBetween(Window.unboundedPreceding, -1)
    wide = prepared.select(
        "*",
        (F.row_number().over(window) - 1).cast("long").alias("_n"),
        F.max("days_past_due").over(past).alias("_max_dpd"),
        F.min("payment_ratio").over(past).alias("_min_ratio"),
        *[F.coalesce(F.sum(v()).over(past), F.lit(0)).alias(f"_s_{k}") for k, v in _RUNNING_SUMS.items()],
        *[c.alias(n) for n, c in _recent(window).items()],
    )
    return _from_totals(wide)


def _history_chunked(prepared: DataFrame, chunk_rows: int) -> DataFrame:
    """The same for credits too long for one task: windows per chunk plus totals of earlier chunks."""
    rows = chunked(prepared, "credit_id", instalment_order(), before=6, chunk_rows=chunk_rows)
    window = Window.partitionBy("credit_id", "_chunk").orderBy("_position")
    past = window.rowsBetween(Window.unboundedPreceding, -1)
    own = ~F.col("_halo")
    wide = rows.select(
        "*",
        F.max(F.when(own, F.col("days_past_due"))).over(past).alias("_max_dpd"),
        F.min(F.when(own, F.col("payment_ratio"))).over(past).alias("_min_ratio"),
        *[F.coalesce(F.sum(F.when(own, v())).over(past), F.lit(0)).alias(f"_s_{k}") for k, v in _RUNNING_SUMS.items()],
        *[c.alias(n) for n, c in _recent(window).items()],
    ).where(own)
    totals = rows.where(own).groupBy("credit_id", "_chunk").agg(
        F.max("days_past_due").alias("_tm"), F.min("payment_ratio").alias("_tr"),
        *[F.sum(v()).alias(f"_t_{k}") for k, v in _RUNNING_SUMS.items()],
    )
    earlier = Window.partitionBy("credit_id").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "credit_id", "_chunk",
        F.max("_tm").over(earlier).alias("_om"), F.min("_tr").over(earlier).alias("_or"),
        *[F.coalesce(F.sum(f"_t_{k}").over(earlier), F.lit(0)).alias(f"_o_{k}") for k in _RUNNING_SUMS],
    )
    kept = [*prepared.columns, *_recent(window)]
    joined = wide.join(offsets, ["credit_id", "_chunk"]).select(
        *kept,
        (F.col("_position") - 1).alias("_n"),
        F.greatest("_max_dpd", "_om").alias("_max_dpd"),
        F.least("_min_ratio", "_or").alias("_min_ratio"),
        *[(F.col(f"_s_{k}") + F.col(f"_o_{k}")).alias(f"_s_{k}") for k in _RUNNING_SUMS],
    )
    return _from_totals(joined)


def history_features(
    prepared: DataFrame, hot=FIND, hot_rows: int = HOT_ROWS, chunk_rows: int = 100_000
) -> DataFrame:
    """Features of each row from earlier instalments of its credit only.

    ``hot`` is a frame of credits too long for one task, None for none, or left to be found.
    """
    if hot is FIND:
        hot = hot_keys(prepared, "credit_id", hot_rows)
    if hot is None:
        return _history_per_credit(prepared)
    ordinary, long = split_hot(prepared, hot, "credit_id")
    return _history_per_credit(ordinary).unionByName(_history_chunked(long, chunk_rows))


def delinquency_events(featured: DataFrame, min_history: int = V.DEFAULT_MIN_HISTORY) -> DataFrame:
    """Late or partial rows with enough history, with the current state under its own names.

    History is computed before this filter and must be: Spark does not move it below the windows.
    """
    late_or_partial = (F.col("is_late") == 1) | (F.col("is_partial") == 1)
    return featured.where(late_or_partial & (F.col("hist_count") >= min_history)).select(
        "*",
        fill_zero(F.col("instalment")).alias("amount_due"),
        F.coalesce(F.col("number"), F.lit(0)).alias("instalment_no"),
        F.coalesce(F.col("due_day"), F.lit(0)).alias("relative_due_day"),
    )


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in a stated order.

    Spark limits row_number to rank 1 before the shuffle, so a hot key sends one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank")


def _total_order(df: DataFrame) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in df.columns]


def join_previous(events: DataFrame, previous: DataFrame) -> DataFrame:
    """Left join on credit and customer; ``previous`` is made unique on the credit first.

    Both sides are partitioned by credit already, so they meet on the credit alone and a row of
    another customer is blanked, which spares a shuffle on the pair of keys.
    """
    if not {"credit_id", "customer_id"} <= set(previous.columns):
        return events
    unique = first_per_key(previous, ["credit_id"], _total_order(previous)).withColumnRenamed("customer_id", "_owner")
    joined = _left_join(events, unique, ["credit_id"], "_prev")
    added = [c for c in joined.columns if c not in events.columns and c != "_owner"]
    mine = F.col("_owner") == F.col("customer_id")
    return joined.select(*events.columns, *[F.when(mine, F.col(c)).alias(c) for c in added])


def join_application(events: DataFrame, application: DataFrame) -> DataFrame:
    if "customer_id" not in application.columns:
        return events
    unique = first_per_key(application, ["customer_id"], _total_order(application))
    return _left_join(events, unique, ["customer_id"], "_app")


def _left_join(left: DataFrame, right: DataFrame, keys: list[str], suffix: str) -> DataFrame:
    taken = set(left.columns) - set(keys)
    right = right.withColumnsRenamed({c: f"{c}{suffix}" for c in right.columns if c in taken})
    return left.join(right, keys, "left")


def collection_snapshots(
    instalments: DataFrame,
    previous: DataFrame | None = None,
    application: DataFrame | None = None,
    min_history: int = V.DEFAULT_MIN_HISTORY,
    hot=FIND,
) -> DataFrame:
    """Delinquency events with their history, and with previous and application columns if given."""
    events = delinquency_events(history_features(prepare_instalments(instalments), hot), min_history)
    if previous is not None:
        events = join_previous(events, previous)
    if application is not None:
        events = join_application(events, application)
    return events

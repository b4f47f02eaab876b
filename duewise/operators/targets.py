"""Forward-looking targets of a delinquency event."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duewise import fixed_values as V
from duewise.functions.expressions import fill_zero, require_columns
from duewise.operators.history import instalment_order
from duewise.operators.ordering import FIND, HOT_ROWS, chunked, hot_keys, split_hot

TARGET_COLUMNS = ("credit_id", "due_day", "number", "instalment", "payment", "payment_ratio", "days_past_due")
_STEPS = (1, 2, 3)


def _targets(df: DataFrame, window: Window, horizon: int) -> DataFrame:
    seen, paid, good = [], [], []
    for step in _STEPS:
        def ahead(name: str):
            return F.lead(name, step).over(window)

        gap = ahead("due_day") - F.col("due_day")
        inside = F.coalesce((gap > 0) & (gap <= horizon), F.lit(False))
        seen.append(inside)
        # Both amounts are filled with 0, so least() never meets a null.
        paid.append(F.when(inside, F.least(fill_zero(ahead("payment")), fill_zero(ahead("instalment")))).otherwise(0.0))
        good.append(
            inside
            & (fill_zero(ahead("payment_ratio")) >= V.FULL_PAYMENT_RATIO)
            & (F.coalesce(ahead("days_past_due"), F.lit(V.UNKNOWN_DAYS_PAST_DUE)) <= V.CURED_MAX_DAYS_PAST_DUE)
        )
    any_seen = reduce(lambda a, b: a | b, seen)
    any_good = reduce(lambda a, b: a | b, good)
    return df.select(
        "*",
        any_seen.cast("int").alias("has_future_observation"),
        F.when(any_seen, any_good.cast("int")).alias("cured_in_horizon"),
        F.when(any_seen, paid[0] + paid[1] + paid[2]).alias("recovered_in_horizon"),
    )


def forward_targets(
    events: DataFrame,
    horizon_days: int = V.DEFAULT_HORIZON_DAYS,
    hot=FIND,
    hot_rows: int = HOT_ROWS,
    chunk_rows: int = 100_000,
) -> DataFrame:
    """Cure and recovered amount over the next three rows of the credit within the horizon.

    Given events, the next rows are delinquent instalments; give the featured instalments instead to
    look at every later instalment. Both targets are null without a later row in the horizon.
    """
    require_columns(events, TARGET_COLUMNS, "targets")
    plain = Window.partitionBy("credit_id").orderBy(*instalment_order())
    if hot is FIND:
        hot = hot_keys(events, "credit_id", hot_rows)
    if hot is None:
        out = _targets(events, plain, horizon_days)
    else:
        ordinary, long = split_hot(events, hot, "credit_id")
        rows = chunked(long, "credit_id", instalment_order(), after=len(_STEPS), chunk_rows=chunk_rows)
        per_chunk = Window.partitionBy("credit_id", "_chunk").orderBy("_position")
        cut = _targets(rows, per_chunk, horizon_days).where(~F.col("_halo")).drop("_position", "_chunk", "_halo")
        out = _targets(ordinary, plain, horizon_days).unionByName(cut)
    if horizon_days == V.DEFAULT_HORIZON_DAYS:
        out = out.select(
            "*",
            F.col("cured_in_horizon").alias("cured_in_horizon_60d"),
            F.col("recovered_in_horizon").alias("recovered_in_horizon_60d"),
        )
    return out


def labelled_events(dataset: DataFrame) -> DataFrame:
    return dataset.dropna(subset=["cured_in_horizon", "recovered_in_horizon"])

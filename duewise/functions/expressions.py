"""Column expressions. All stay JVM-side; null is the only missing value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duewise import fixed_values as V

INFINITY = float("inf")
ROUNDING_CUT = 0.5371


def to_number(col: Column) -> Column:
    """Double, or null when the value is no number (NaN included)."""
    number = col.try_cast("double")
    return F.when(~F.isnan(number), number)


def safe_divide(numerator: Column, denominator: Column, default: float = 0.0) -> Column:
    ratio = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    finite = F.when(~F.isnan(ratio) & (F.abs(ratio) != F.lit(INFINITY)), ratio)
    return F.coalesce(finite, F.lit(float(default)))


def clip(col: Column, low: float | None = None, high: float | None = None) -> Column:
    """Bound a column; null stays null, which greatest/least would not keep."""
    out = None
    if low is not None:
        out = F.when(col < F.lit(low), F.lit(low))
    if high is not None:
        out = (F if out is None else out).when(col > F.lit(high), F.lit(high))
    return col if out is None else out.otherwise(col)


def flag(condition: Column) -> Column:
    """1 when true, 0 when false or null."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def fill_zero(col: Column) -> Column:
    return F.coalesce(col, F.lit(0.0))


def sum_or_zero(col: Column) -> Column:
    """A sum that is 0, not null, when every value is null."""
    return F.coalesce(F.sum(col), F.lit(0.0))


def status_number(status: Column) -> Column:
    """Bureau month status: C is 0, 0 to 5 are themselves, X and all else unknown."""
    return (
        F.when(status == "C", F.lit(0))
        .when(status.isin("0", "1", "2", "3", "4", "5"), status.try_cast("int"))
    )


def infer_channel(action: Column) -> Column:
    """Channel of an action text; the first matching rule wins."""
    text = F.lower(F.coalesce(action, F.lit("")))
    chain = F
    for channel, pattern in V.CHANNEL_PATTERNS.items():
        chain = chain.when(text.rlike(pattern), F.lit(channel))
    return chain.otherwise(F.lit(V.CHANNEL_MANUAL))


def safe_roi(value: Column, cost: Column) -> Column:
    """value/cost; a free action that gains ranks above all, a free one that does not at 0."""
    return (
        F.when(cost > 0, F.try_divide(value, cost))
        .when(value > 0, F.lit(INFINITY))
        .otherwise(F.lit(0.0))
    )


def entity_key(*cols: Column) -> Column:
    """Pipe-joined key that keeps a place for a null part."""
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("null")) for c in cols])


def log_amount(amount: Column) -> Column:
    return F.log1p(clip(amount, low=0.0))


def amount_from_log(prediction: Column) -> Column:
    return clip(F.expm1(prediction), low=0.0)


def cap_by_debt(predicted: Column, amount_due: Column) -> Column:
    debt = clip(fill_zero(to_number(amount_due)), low=0.0)
    return F.when(predicted > debt, debt).otherwise(predicted)


def tier(value: Column, low: float | None, high: float | None, labels: tuple, default: str) -> Column:
    """(-inf, low], (low, high], (high, inf); null, or thresholds that collapse, give the default."""
    if low is None or high is None or not low < high:
        return F.lit(default)
    return (
        F.when(value <= F.lit(low), F.lit(labels[0]))
        .when(value <= F.lit(high), F.lit(labels[1]))
        .when(value > F.lit(high), F.lit(labels[2]))
        .otherwise(F.lit(default))
    )


def prefix_columns(df: DataFrame, prefix: str, keys: list[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns if c not in keys})


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def other_columns(df: DataFrame) -> list[str]:
    numeric = set(numeric_columns(df))
    return [c for c in df.columns if c not in numeric]


def require_columns(df: DataFrame, needed, purpose: str) -> None:
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise ValueError(f"columns missing for {purpose}: {missing}")


def rounded(col: Column, digits: int) -> Column:
    """Rounding by plain arithmetic, the same in every engine.

    The cut lies slightly off the half, where no mean of short decimals falls, so that the last bit of
    a sum cannot decide the result.
    """
    scale = float(10**digits)
    return F.floor(col * F.lit(scale) + F.lit(ROUNDING_CUT)).cast("double") / F.lit(scale)

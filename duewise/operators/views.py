"""Filters and figures a dashboard asks of a decided portfolio."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duewise.operators.decision import tie_breakers


def portfolio_filter(
    df: DataFrame, priorities=(), actions=(), min_p: float = 0.0, min_amount: float = 0.0, review_only: bool = False
) -> DataFrame:
    """Rows that meet every given condition; an empty selection filters nothing."""
    out = df
    if priorities and "priority" in df.columns:
        out = out.where(F.col("priority").isin(*priorities))
    if actions and "action" in df.columns:
        out = out.where(F.col("action").isin(*actions))
    if "p_cure" in df.columns:
        out = out.where(F.col("p_cure") >= min_p)
    if "amount_due" in df.columns:
        out = out.where(F.col("amount_due") >= min_amount)
    if review_only and "needs_human_review" in df.columns:
        out = out.where(F.col("needs_human_review"))
    return out


def portfolio_kpis(df: DataFrame) -> DataFrame:
    """One row of counts and sums; figures whose column is absent are left out."""
    sums = {
        "amount_due": "amount_due", "expected_recovery": "expected_recovery",
        "action_cost": "action_cost", "expected_net_value": "expected_net_value",
    }
    aggs = [F.coalesce(F.sum(c), F.lit(0.0)).alias(n) for n, c in sums.items() if c in df.columns]
    if "needs_human_review" in df.columns:
        aggs.append(F.count_if("needs_human_review").alias("human_reviews"))
    return df.agg(F.count(F.lit(1)).alias("rows"), *aggs)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.col("rows").desc(), column)


def ranking_head(df: DataFrame, rows: int = 300) -> DataFrame:
    """The first rows of the ranking; each task keeps only its own first rows."""
    return df.orderBy(F.col("expected_net_value").desc_nulls_last(), *tie_breakers(df)).limit(rows)

"""Positions and running totals over a global order, without a one-task window.

An unpartitioned window, or a window over a key that holds a large share of the rows, sends that
share to one task. Here rows are range-partitioned on the whole order (ties broken by later
columns), so any key or score, however frequent, spreads over many segments. Each segment adds up
its own rows; the few segment totals are added up and joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duewise.session import staged

HOT_ROWS = 1_000_000
LISTED_KEYS = 10_000  # hot keys held as a list; more are written as a table
FIND = object()  # look for hot keys here, rather than take them from the caller


def running(
    df: DataFrame,
    order: list[Column],
    by: list[str] | None = None,
    sums: dict[str, Column] | None = None,
    position: str = "position",
    segments: int | None = None,
) -> DataFrame:
    """Add the 1-based ``position`` and inclusive running ``sums`` in ``order`` within ``by``.

    ``order`` should end in a key that makes it total; exact copies, which no order can tell apart,
    are spread by a row number of the scan. The input is read twice (bounds, then rows) and its row
    numbers must not change, so give a scan or a staged table. The result is a staged table.
    """
    by, sums = by or [], sums or {}
    spark = df.sparkSession
    segments = segments or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [*order, F.col("_copy")]
    tagged = (
        df.withColumn("_copy", F.monotonically_increasing_id())
        .repartitionByRange(segments, *[F.col(c).asc() for c in by], *order)
        .withColumn("_segment", F.spark_partition_id())
    )
    inside = Window.partitionBy("_segment", *by).orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = tagged.select(
        "*",
        F.row_number().over(inside).cast("long").alias("_local"),
        *[F.sum(c).over(so_far).alias(f"_local_{n}") for n, c in sums.items()],
        *[c.alias(f"_value_{n}") for n, c in sums.items()],
    )
    local = staged(local, "running")

    # One row per (segment, key) pair: at most one more pair per segment than there are keys.
    totals = local.groupBy("_segment", *by).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(f"_value_{n}").alias(f"_sum_{n}") for n in sums]
    )
    before = Window.partitionBy(*by).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_segment",
        *by,
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
        *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_offset_{n}") for n in sums],
    )
    # Without groups there is at most a row per segment. Otherwise the offsets are written, so that
    # Spark knows their true size when it picks the join.
    offsets = staged(offsets, "offsets") if by else F.broadcast(offsets)
    # A null key is a key like any other here.
    named = offsets.select(*[F.col(c).alias(f"_of_{c}") for c in ("_segment", *by)], *offsets.columns[1 + len(by) :])
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in ("_segment", *by)]
    return local.join(named, same).select(
        *df.columns,
        (F.col("_offset") + F.col("_local")).alias(position),
        *[(F.col(f"_offset_{n}") + F.coalesce(F.col(f"_local_{n}"), F.lit(0))).alias(n) for n in sums],
    )


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys so frequent that one task should not hold them, or None.

    Found on a sample in which a key at the limit is expected a thousand times. A key missed or
    found near the limit only takes the other of two equal paths, so the sample never shows in
    results. There can be at most rows / limit such keys.
    """
    fraction = min(1.0, 1000.0 / hot_rows)
    sample = df.select(key) if fraction == 1.0 else df.select(key).sample(fraction, seed=7)
    keys = (
        sample.where(F.col(key).isNotNull())
        .groupBy(key)
        .count()
        .where(F.col("count") > 0.5 * fraction * hot_rows)
        .select(key)
    )
    few = keys.limit(LISTED_KEYS + 1).collect()
    if not few:
        return None
    if len(few) <= LISTED_KEYS:
        return F.broadcast(df.sparkSession.createDataFrame(few, keys.schema))  # LISTED_KEYS rows at most
    return staged(keys, "hot")


def split_hot(df: DataFrame, hot: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary keys, rows of hot keys); a null key counts as ordinary."""
    return df.join(hot, key, "left_anti"), df.join(hot, key, "left_semi")


def chunked(
    df: DataFrame, key: str, order: list[Column], before: int = 0, after: int = 0, chunk_rows: int = 100_000
) -> DataFrame:
    """Cut each key's ordered rows into chunks that overlap by the rows a frame looks at.

    Adds ``_position``, ``_chunk`` and ``_halo``. A row also appears, as halo, in the next chunk when
    it is among the ``before`` rows ahead of it, and in the previous one when among the ``after``
    rows behind it. A window per (key, chunk) then sees all its frame needs.
    """
    placed = running(df, order, by=[key], position="_position")
    index = F.col("_position") - 1
    own = F.floor(index / chunk_rows)
    seen = [own]
    if before:
        seen.append(F.floor((index + before) / chunk_rows))
    if after:
        seen.append(F.floor(F.when(index >= after, index - after).otherwise(index) / chunk_rows))
    return placed.withColumn("_chunk", F.explode(F.array_distinct(F.array(*seen)))).withColumn(
        "_halo", F.col("_chunk") != own
    )

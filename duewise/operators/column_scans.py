"""Sums over all numeric columns of a table, added up column by column within tasks.

A row per cell would have to be hashed for each aggregate. Here a task takes some rows at a time,
a column after the other, so that what leaves it is a few rows per piece and column.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE_ROWS = 1 << 17  # rows that a task looks at together
TOGETHER = 24  # columns read together: of many more, the method that Spark makes to read a row is one the JVM does not compile
POINTS = 50_000  # at least so many values of a column go on from a large table, all from a small one


def in_groups(columns: list[str]) -> list[list[str]]:
    """The columns by groups that are read together. Each group reads its own columns only, so ``df`` has to be a scan."""
    return [columns[k : k + TOGETHER] for k in range(0, len(columns), TOGETHER)]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _in_pieces(names: list[str], most: int):
    """Some batches at a time, as (rows, values of each column that are there). Nested, so that workers get it by value."""
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray]]]:
        held, rows = [], 0

        def numbers(k):
            v = np.concatenate([b.column(k).drop_null().to_numpy(zero_copy_only=False) for b in held]).astype(np.float64, copy=False)
            return v[~np.isnan(v)] + 0.0  # NaN is missing, minus zero is zero

        def joined():
            return rows, [numbers(k) for k in range(len(names))]

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= most:
                yield joined()
                held, rows = [], 0
        if rows:
            yield joined()

    return pieces


def ranked_points(df: DataFrame, columns: dict[str, Column], every: int = 1) -> DataFrame:
    """Moments of each column in each piece, and every so many-th of its sorted values; one row per piece and column.

    The columns are numbers; NaN counts as missing, minus zero as zero. That is seen to here: a projection of
    a hundred such columns is more than the JVM compiles. A point stands for ``every`` values of about its
    rank, so ranks among all points are off by less than ``every`` per piece, and by chance to either side.
    """
    return _union([_ranked_points(df, {n: columns[n] for n in group}, every) for group in in_groups(list(columns))])


def _ranked_points(df: DataFrame, columns: dict[str, Column], every: int) -> DataFrame:
    names = list(columns)
    pieces = _in_pieces(names, PIECE_ROWS)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed = [every // 2] * len(names)  # values since the last point
        for rows, found in pieces(batches):
            out = []
            for k, (name, v) in enumerate(zip(names, found)):
                v, n = np.sort(v), len(v)
                points = v[every - 1 - passed[k] :: every]
                passed[k] = (passed[k] + n) % every
                with np.errstate(all="ignore"):
                    mean = float(v.mean()) if n else None
                    squares = float(((v - mean) ** 2).sum()) if n else None
                out.append({
                    "column": name, "rows": rows, "n": n, "mean": mean, "squares": squares, "min": float(v[0]) if n else None,
                    "max": float(v[-1]) if n else None, "zero": int(np.searchsorted(v, 0.0, "right") - np.searchsorted(v, 0.0)),
                    "negative": int(np.searchsorted(v, 0.0)), "points": points,
                })
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("column", pa.string()), ("rows", pa.int64()), ("n", pa.int64()), ("mean", pa.float64()), ("squares", pa.float64()),
                ("min", pa.float64()), ("max", pa.float64()), ("zero", pa.int64()), ("negative", pa.int64()), ("points", pa.list_(pa.float64())),
            ]))

    return df.select(*[c.alias(n) for n, c in columns.items()]).mapInArrow(
        measured, "column string, rows long, n long, mean double, squares double, min double, max double, zero long, negative long, points array<double>")


def moments(pieces: DataFrame, *by: str) -> DataFrame:
    """The pieces' moments added up: rows, count, mean, std, min, max, zero and negative per group."""
    n, weighted = F.col("n"), F.col("n") * F.col("mean")
    means = pieces.groupBy(*by).agg(F.try_divide(F.sum(weighted), F.sum(n).cast("double")).alias("_mean"))
    # A row per group: the whole's mean beside the pieces', so that squares are about it.
    both = pieces.drop("points").join(F.broadcast(means), list(by))
    apart = F.col("mean") - F.col("_mean")
    return both.groupBy(*by).agg(
        F.sum("rows").alias("rows"), F.sum(n).alias("count"), F.first("_mean").alias("mean"),
        F.sqrt(F.try_divide(F.sum(F.col("squares") + n * apart * apart), (F.sum(n) - 1).cast("double"))).alias("std"),
        F.min("min").alias("min"), F.max("max").alias("max"), F.sum("zero").alias("zero"), F.sum("negative").alias("negative"),
    )


def counts_in_zones(df: DataFrame, columns: dict[str, Column], zones: dict[str, list[tuple[float, float]]]) -> DataFrame:
    """name, zone, value, n: rows per column, zone and listed value, added up within tasks and then over them.

    The 2 k + 1st zone is the k-th bracket, whose values are listed; even zones lie between brackets and
    are only counted (value is null). The columns are numbers as in ``ranked_points``.
    """
    found = _union([_counts_in_zones(df, {n: columns[n] for n in group}, zones) for group in in_groups(list(columns))])
    return found.groupBy("name", "zone", "value").agg(F.sum("n").alias("n"))


def _counts_in_zones(df: DataFrame, columns: dict[str, Column], zones: dict[str, list[tuple[float, float]]]) -> DataFrame:
    names = list(columns)
    lows = [np.array([low for low, _ in zones[n]]) for n in names]
    highs = [np.array([high for _, high in zones[n]]) for n in names]
    pieces = _in_pieces(names, PIECE_ROWS)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(2 * len(z) + 1, np.int64) for z in lows]
        for _, found in pieces(batches):
            for name, v, low, high, total in zip(names, found, lows, highs, totals):
                at = np.searchsorted(low, v, "right")
                inside = np.zeros(len(v), bool)
                if len(low):
                    inside = (at > 0) & (v <= high[np.maximum(at - 1, 0)])
                total[::2] += np.bincount(at[~inside], minlength=len(low) + 1)
                values, first, n = np.unique(v[inside], return_index=True, return_counts=True)
                if len(values):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(values)), pa.array((2 * at[inside][first] - 1).astype(np.int32)), pa.array(values), pa.array(n.astype(np.int64))],
                        names=["name", "zone", "value", "n"])
        between = [(name, zone, int(total[zone])) for name, total in zip(names, totals) for zone in np.flatnonzero(total).tolist()]
        if between:
            yield pa.RecordBatch.from_arrays(
                [pa.array([b[0] for b in between]), pa.array([b[1] for b in between], pa.int32()), pa.nulls(len(between), pa.float64()),
                 pa.array([b[2] for b in between], pa.int64())], names=["name", "zone", "value", "n"])

    return df.select(*[c.alias(n) for n, c in columns.items()]).mapInArrow(counted, "name string, zone int, value double, n long")

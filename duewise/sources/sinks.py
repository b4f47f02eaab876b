"""Writers of tables and of one-row JSON reports."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """One task writes each partition; nothing is gathered."""
    writer = df.write.mode("overwrite")
    (writer.option("header", True).csv(path) if fmt == "csv" else writer.parquet(path))
    return path


def write_tables(tables: dict[str, DataFrame | None], folder: str, fmt: str = "parquet") -> dict[str, str]:
    return {n: write_table(df, f"{folder}/{n}", fmt) for n, df in tables.items() if df is not None}


def write_report(one_row: DataFrame, path: str) -> str:
    """A report is a single row, so one file."""
    one_row.coalesce(1).write.mode("overwrite").json(path)
    return path

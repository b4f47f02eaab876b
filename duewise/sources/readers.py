"""Readers for the credit tables, and customer-consistent sampling."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duewise.functions.expressions import to_number
from duewise.sources.schemas import CORE, OPTIONAL, SHORT_NAMES, TABLES

_PARQUET = (".parquet", ".pq")
_SUFFIXES = ("", ".csv", ".csv.gz", ".parquet", ".pq")


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(path)


def _filesystem(spark: SparkSession, path):
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    target = _path(spark, path)
    return _filesystem(spark, target).exists(target)


def resolve_table(spark: SparkSession, folder: str, stem: str) -> str | None:
    """First of: exact name, csv, csv.gz, parquet, pq, then any name that starts with the stem.

    Goes through the Hadoop file system, so object stores and local folders work alike.
    """
    for suffix in _SUFFIXES:
        candidate = f"{folder}/{stem}{suffix}"
        if path_exists(spark, candidate):
            return candidate
    pattern = _path(spark, f"{folder}/{stem}*")
    found = _filesystem(spark, pattern).globStatus(pattern)
    names = sorted(s.getPath().toString() for s in (found or []))
    return next((n for n in names if not n.rsplit("/", 1)[-1].startswith(".")), None)


def without_nan(df: DataFrame) -> DataFrame:
    floats = [c for c, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in floats}) if floats else df


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet by its suffix, otherwise CSV with a header (gzip is read as is). NaN counts as missing."""
    if path.lower().rstrip("/").endswith(_PARQUET):
        return without_nan(spark.read.parquet(path))
    # Columns are matched by header name, so the files' column order is free; values come as text.
    header = spark.read.option("header", True).csv(path)
    if schema is None:
        return without_nan(spark.read.option("header", True).option("inferSchema", True).csv(path))
    return header


def scan_projected(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Requested columns that are present, with their declared types; a warning names the absent."""
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    raw = read_table(spark, path, schema)
    absent = sorted(set(schema.names) - set(raw.columns))
    if absent:
        warnings.warn(f"columns absent in {path}: {absent}")
    return raw.select(*[_typed(f) for f in schema.fields if f.name in raw.columns])


def _typed(field: T.StructField):
    if isinstance(field.dataType, T.StringType):
        return F.col(field.name).cast("string").alias(field.name)
    # Counts may be written as 3.0, so integers go through double.
    return to_number(F.col(field.name)).try_cast(field.dataType).alias(field.name)


def _load(spark: SparkSession, folder: str, table: str, required: bool) -> DataFrame | None:
    stem, schema = TABLES[table]
    path = resolve_table(spark, folder, stem)
    if path is None:
        if required:
            raise FileNotFoundError(f"{folder}/{stem}")
        return None
    return scan_projected(spark, path, schema).withColumnsRenamed(SHORT_NAMES)


def load_core_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {t: _load(spark, folder, t, True) for t in CORE}


def load_optional_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame | None]:
    return {t: _load(spark, folder, t, False) for t in OPTIONAL}


def customer_bucket(customer) -> Column:
    """0 to 65535, a function of the key alone, so every table agrees on it without a join."""
    return F.conv(F.substring(F.md5(customer.cast("string")), 1, 4), 16, 10).cast("int")


def sample_relational(tables: dict[str, DataFrame | None], share: float) -> dict[str, DataFrame]:
    """Keep a share of customers, and of every table the rows of the kept customers.

    Tables that carry the customer are filtered where they are scanned; only the monthly bureau table
    follows its parent with a semi join.
    """
    out = {}
    for name, df in tables.items():
        if df is not None and "customer_id" in df.columns:
            out[name] = df.where(customer_bucket(F.col("customer_id")) < int(share * 65536))
    child = tables.get("bureau_balance")
    if child is not None and out.get("bureau") is not None:
        out["bureau_balance"] = child.join(out["bureau"].select("bureau_id").distinct(), "bureau_id", "left_semi")
    return out

"""The data-quality report: every profile of the seven tables, written as tables and JSON."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from duewise.operators import profiling
from duewise.session import scope, staged
from duewise.sources import readers, sinks
from duewise.sources.schemas import SHORT_NAMES, TABLES


def load_for_profile(spark: SparkSession, raw: str, sample_share: float | None = None) -> dict:
    """All columns of each table that is found; None where it is not."""
    tables, paths = {}, {}
    for name, (stem, schema) in TABLES.items():
        path = paths[name] = readers.resolve_table(spark, raw, stem)
        tables[name] = None if path is None else readers.read_table(spark, path).withColumnsRenamed(SHORT_NAMES)
    if sample_share is not None:
        sampled = readers.sample_relational(tables, sample_share)
        tables = {n: sampled.get(n) for n in tables}
    # CSV is parsed once, not once per profile; parquet is read as it is.
    def kept(name, df):
        return df if df is None or paths[name].lower().rstrip("/").endswith((".parquet", ".pq")) else staged(df, name)

    return {n: kept(n, df) for n, df in tables.items()}


def profile_report(
    spark: SparkSession, raw: str, out: str, modelable_path: str | None = None, reported: dict[str, int] | None = None,
    sample_share: float | None = None, run: str | None = None,
) -> dict[str, str]:
    """All profiles under ``out``. ``run`` is the folder of a finished run, whose counts the funnel
    then compares; counts given in ``reported`` win. What is staged is deleted at the end."""
    with scope(spark):
        return _profile_report(spark, raw, out, modelable_path, {**(run_counts(spark, run) if run else {}), **(reported or {})}, sample_share)


def run_counts(spark: SparkSession, run: str) -> dict[str, int]:
    """Events, portfolio rows and rows per split as a run's own summary and metrics tell them."""
    found = {}
    if readers.path_exists(spark, f"{run}/run_summary"):
        row = spark.read.json(f"{run}/run_summary").first()
        for ours, name in (("events", "n_events"), ("portfolio", "n_portfolio")):
            if row is not None and name in row and row[name] is not None:
                found[ours] = int(row[name])
    if readers.path_exists(spark, f"{run}/metrics"):
        for r in spark.read.parquet(f"{run}/metrics").where(F.col("metric").startswith("n_rows_")).collect():
            found[r["metric"].removeprefix("n_rows_")] = int(r["value"])
    return found


def _profile_report(
    spark: SparkSession, raw: str, out: str, modelable_path: str | None, reported: dict[str, int] | None, sample_share: float | None
) -> dict[str, str]:
    tables = load_for_profile(spark, raw, sample_share)
    modelable = None
    if modelable_path and readers.path_exists(spark, modelable_path):
        modelable = spark.read.parquet(modelable_path)
    profiles = {
        "tables": profiling.profile_tables(tables),
        "missing": profiling.sort_missing(profiling.profile_missing(tables)),
        "numeric": profiling.profile_numeric(tables),
        "categorical": profiling.profile_categorical(tables),
        "key_integrity": profiling.key_integrity(tables),
        "targets": profiling.profile_targets(tables.get("application"), modelable),
        "funnel": profiling.data_funnel(tables, modelable, reported),
    }
    paths = sinks.write_tables(profiles, out)
    back = {n: spark.read.parquet(p) for n, p in paths.items()}
    alerts = profiling.quality_alerts(back["missing"], back["categorical"], back["numeric"], back["targets"], back["funnel"])
    paths["alerts"] = f"{out}/alerts"
    alerts.write.mode("overwrite").json(paths["alerts"])
    found = spark.read.schema(alerts.schema).json(paths["alerts"])
    summary = profiling.profile_summary(back["tables"], found).withColumn("raw", F.lit(raw))
    paths["summary"] = sinks.write_report(summary, f"{out}/summary")
    return paths

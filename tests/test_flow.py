import os
import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

from duewise.operators import modelling, quantiles
from duewise.plans.flow import RunConfig, build_dataset, run_collections
from duewise.plans.profile_report import profile_report
from duewise.queries import all_checks, all_queries
from duewise.queries.sources_queries import raw_files
from duewise.session import scope, stage_dir, staged
from duewise.sources import readers
from duewise.sources.schemas import TABLES

SAMPLE = ("history_features", "forward_targets", "join_bureau_status", "portfolio_latest", "metric_auc_gini", "recovery_curve",
          "plan_greedy_limits", "key_integrity", "quality_alerts", "group_split")


@pytest.mark.parametrize("name", SAMPLE)
def test_query_agrees_with_its_sql(spark, folder, name):
    db = duckdb.connect()
    for t in "lineitem orders customer nation events".split():
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    cursor = db.execute(all_checks()[name])
    columns = [c[0] for c in cursor.description]
    df = all_queries()[name](spark, folder)
    assert sorted(df.columns) == sorted(columns)

    def text(rows):
        return sorted(tuple("~" if v is None else repr(float(v)) if isinstance(v, (int, float)) else str(v) for v in r) for r in rows)

    assert text(tuple(r[c] for c in columns) for r in df.collect()) == text(cursor.fetchall())


def test_every_check_belongs_to_a_query():
    assert set(all_checks()) <= set(all_queries())


@pytest.fixture(scope="module")
def raw(spark, folder):
    return raw_files(spark, folder, list(TABLES))


def test_whole_flow(spark, raw):
    out = tempfile.mkdtemp(prefix="flow-")
    paths = run_collections(spark, raw, out, RunConfig(horizon_days=180, budget=50_000, trees=4, depth=3, simulations=5))
    portfolio, plan = spark.read.parquet(paths["portfolio"]), spark.read.parquet(paths["plan"])
    assert portfolio.count() == portfolio.select("credit_id").distinct().count()
    assert 0 < plan.agg({"action_cost": "sum"}).first()[0] <= 50_000
    assert spark.read.parquet(paths["benchmark"]).count() == 24
    assert spark.read.parquet(paths["recovery_curve"]).count() == 100
    metrics = {r["metric"]: r["value"] for r in spark.read.parquet(paths["metrics"]).collect()}
    # The given tables hold no signal about the next instalments; see test_modelling for learning.
    assert 0.0 < metrics["roc_auc"] < 1.0 and 0 < metrics["brier_score"] < 0.35
    summary = spark.read.json(paths["summary"]).first()
    assert summary["n_portfolio"] == portfolio.count() and "DAYS_BIRTH" in summary["removed_features"]
    again = modelling.load_model(f"{out}/model", spark)
    assert again.numeric and again.metrics["n_rows_train"] > 0

    report = profile_report(spark, raw, f"{out}/profile", paths["modelable"], {"portfolio": summary["n_portfolio"]})
    found = spark.read.json(report["summary"]).first()
    assert found["tables_found"] == 7 and found["tables_missing"] == 0 and found["high_severity_alerts"] > 0


def test_sampling_keeps_whole_customers(spark, raw):
    tables = dict(readers.load_core_tables(spark, raw)) | readers.load_optional_tables(spark, raw)
    sampled = readers.sample_relational(tables, 0.3)
    kept = {r[0] for r in sampled["application"].select("customer_id").collect()}
    assert {r[0] for r in sampled["instalments"].select("customer_id").distinct().collect()} <= kept
    assert 0 < len(kept) < tables["application"].count()
    assert build_dataset(sampled, RunConfig()).count() > 0


def test_absent_tables_and_columns(spark, raw):
    with pytest.raises(FileNotFoundError):
        readers.load_core_tables(spark, f"{stage_dir(spark)}/nowhere")
    path = readers.resolve_table(spark, raw, "installments_payments")
    schema = TABLES["instalments"][1]
    from pyspark.sql import types as T

    with pytest.warns(UserWarning, match="EXTRA"):
        df = readers.scan_projected(spark, path, T.StructType([*schema.fields, T.StructField("EXTRA", T.StringType())]))
    assert "EXTRA" not in df.columns


def test_rows_without_a_customer_stay_in_the_splits(spark):
    rows = [(i // 2 if i % 2 else None, i, i % 2) for i in range(400)]
    df = spark.createDataFrame(rows, "customer_id long, id long, label int")
    for given in (df, df.drop("customer_id")):
        out = modelling.split_rows(given)
        assert out.count() == 400 and {r[0] for r in out.select("split").distinct().collect()} == set(modelling.SPLITS)


def test_nan_is_missing_in_every_profile(spark):
    place = tempfile.mkdtemp(prefix="nan-")
    rows = [(1, 1.0, "a"), (2, 2.0, "b"), (3, float("nan"), "b"), (4, 0.0, None), (5, -0.0, "b")]
    spark.createDataFrame(rows, "SK_ID_CURR long, AMT_CREDIT double, NAME_INCOME_TYPE string").withColumn("TARGET", F.lit(1)).write.parquet(
        f"{place}/application_train.parquet")
    spark.createDataFrame([(1, 1), (2, 2)], "SK_ID_PREV long, SK_ID_CURR long").write.parquet(f"{place}/previous_application.parquet")
    paths = profile_report(spark, place, f"{place}/out")
    numeric = {r["column"]: r for r in spark.read.parquet(paths["numeric"]).collect()}
    assert numeric["AMT_CREDIT"]["count"] == 4 and numeric["AMT_CREDIT"]["median"] == 0.5 and numeric["AMT_CREDIT"]["zero_pct"] == 0.5
    missing = {r["column"]: r for r in spark.read.parquet(paths["missing"]).collect()}
    assert missing["AMT_CREDIT"]["missing_count"] == 1 and missing["AMT_CREDIT"]["unique_count"] == 3


def test_quantiles_of_raw_nan_and_missed_brackets(spark, monkeypatch):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "v double")
    assert quantiles.exact_quantiles(df, {"v": F.col("v")}, {"v": [0.5]}) == {"v": {0.5: 1.5}}
    real = quantiles._brackets

    def off(frame, probabilities, rows, widening=1):
        zones = real(frame, probabilities, rows, widening)
        return {n: [quantiles._Zone(z.high + 1e9, z.high + 2e9) for z in zs] for n, zs in zones.items()} if widening == 1 else zones

    monkeypatch.setattr(quantiles, "_brackets", off)
    many = spark.range(1001).select(F.col("id").cast("double").alias("v"))
    assert quantiles.exact_quantiles(many, {"v": F.col("v")}, {"v": [0.25, 0.5]}) == {"v": {0.25: 250.0, 0.5: 500.0}}


def test_staged_tables_go_at_the_end_of_a_scope(spark):
    folder = stage_dir(spark)
    before = set(os.listdir(folder))
    with scope(spark):
        assert staged(spark.range(5).toDF("id")).count() == 5
        assert set(os.listdir(folder)) > before
    with pytest.raises(RuntimeError), scope(spark):
        staged(spark.range(5).toDF("id"))
        raise RuntimeError
    assert set(os.listdir(folder)) == before


def test_few_customers_are_split_by_rows(spark):
    df = spark.createDataFrame([(i % 3, i, i % 2) for i in range(500)], "customer_id long, id long, label int")
    out = modelling.split_rows(df)
    assert out.count() == 500 and {r[0] for r in out.select("split").distinct().collect()} == set(modelling.SPLITS)

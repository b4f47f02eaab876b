import os
import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from duewise.operators import boosting, column_scans, modelling, policy, profiling, quantiles
from duewise.queries import decisions, features, model_queries
from duewise.session import stage_dir, staged


def _size(path):
    return sum(os.path.getsize(f"{at}/{f}") for at, _, files in os.walk(path) for f in files)


def _stages(spark, name):
    return {f for f in os.listdir(stage_dir(spark)) if f.startswith(f"{name}-")}


def test_staging_leaves_no_shuffle_files(spark):
    local = spark.sparkContext.getConf().get("spark.local.dir", None) or "/tmp"
    places = [f"{local}/{d}" for d in os.listdir(local) if d.startswith("blockmgr-")]
    before = sum(map(_size, places))
    staged(spark.range(0, 400_000, 1, 4).select(F.sha2(F.col("id").cast("string"), 256).alias("k")).distinct(), "distinct")
    assert sum(map(_size, places)) - before < 5_000_000  # the shuffle wrote some 13 MB


def test_feature_columns_of_a_scan_and_of_any_rows(spark):
    rows = [(1, None, float("nan"), "a" if k % 2 else None, f"t{k}", None, k % 3 == 0) for k in range(100)]
    df = spark.createDataFrame(rows, "hist_a int, none double, nan double, few string, many string, empty string, truth boolean")
    wanted = (["hist_a", "nan"], ["few", "truth"])
    assert policy.feature_columns(df) == policy.feature_columns(df, scan=False) == wanted
    assert policy.feature_columns(df, 100, scan=False) == (["hist_a", "nan"], ["few", "many", "truth"])


def test_feature_rows_write_no_copy_of_the_events(spark, folder):
    before = _stages(spark, "features")
    assert features.QUERIES["feature_columns"](spark, folder).count() > 50
    assert _stages(spark, "features") == before


def test_reasons_are_found_in_a_narrow_copy(spark, folder):
    before = _stages(spark, "enriched")
    decisions.QUERIES["reason_codes"](spark, folder).count()
    [new] = _stages(spark, "enriched") - before
    assert len(spark.read.parquet(f"{stage_dir(spark)}/{new}").columns) == 11


def test_encoding_writes_its_events_once(spark, folder):
    before = _stages(spark, "enriched")
    model_queries.QUERIES["categorical_encoding"](spark, folder).count()
    assert _stages(spark, "enriched") == before


def test_splits_with_a_known_place_are_those_of_all_columns(spark):
    rows = spark.createDataFrame([(None if i % 3 == 0 else i % 40, float(i), i % 2) for i in range(400)], "customer_id int, x double, label int")
    for some in (rows, rows.where("customer_id < 5 OR customer_id IS NULL")):
        plain, known = modelling.split_rows(some), modelling.split_rows(modelling.with_spot(some))
        assert known.columns == plain.columns and sorted(map(str, known.collect())) == sorted(map(str, plain.collect()))


def test_nan_and_minus_zero_in_scans_by_groups(spark, monkeypatch):
    monkeypatch.setattr(column_scans, "TOGETHER", 2)
    monkeypatch.setattr(quantiles, "POINTS", 300)
    draw = random.Random(3)
    rows = [tuple(draw.choice([float("nan"), None, -0.0, draw.gauss(0, 1)]) for _ in range(5)) for _ in range(2_000)]
    df = staged(spark.createDataFrame(rows, "a double, b double, c double, d double, e double"), "nan")
    for k, (c, found) in enumerate(quantiles.lower_medians(df, list("abcde")).items()):
        values = sorted(r[k] + 0.0 for r in rows if r[k] is not None and r[k] == r[k])
        assert found == values[(len(values) - 1) // 2], c


def test_sparse_columns_are_bracketed_at_once(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "POINTS", 400)
    monkeypatch.setattr(column_scans, "PIECE_ROWS", 500)
    tried, real = [], quantiles._quantiles
    monkeypatch.setattr(quantiles, "_quantiles", lambda *a: tried.append(a[4]) or real(*a))
    df = staged(spark.range(0, 40_000, 1, 4).selectExpr(*[f"IF(pmod(xxhash64(id, {k}), 25) = 0, xxhash64({k}, id) / 1e9, NULL) AS c{k}" for k in range(8)]), "sparse")
    found = quantiles.lower_medians(df, df.columns)
    for c in df.columns:
        values = sorted(r[0] for r in df.select(c).where(F.col(c).isNotNull()).collect())
        assert found[c] == values[(len(values) - 1) // 2]
    assert tried == [1]


def test_trees_on_varying_features_are_those_on_all(spark):
    draw, rows = random.Random(2), []
    for _ in range(500):
        a, b = draw.gauss(0, 1), draw.uniform(0, 4)
        rows.append((0.0, a, 7.0, b, 0.0, 1 if a + draw.gauss(0, 1) > 0 else 0, a + b))
    df = staged(VectorAssembler(inputCols=["z", "a", "s", "b", "y"], outputCol="features").transform(
        spark.createDataFrame(rows, "z double, a double, s double, b double, y double, label int, t double")).withColumn("_weight", F.lit(1.0)), "rows")
    assert boosting._varying(df) == [1, 3]
    sliced = boosting.boost_classifier(df, df, 4, 3, 1, patience=99)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(boosting, "_varying", lambda train: None)
        assert boosting.boost_classifier(df, df, 4, 3, 1, patience=99) == sliced
    model = boosting.boost_absolute(df, df, "t", 3, 3, 1)
    assert {f for t in model.trees for f in t.feature} <= {-1, 1, 3}


def test_growing_leaves_no_copies_behind(spark):
    df = staged(VectorAssembler(inputCols=["a"], outputCol="features").transform(
        spark.range(200).selectExpr("id * 1.0D AS a", "pmod(id, 17) * 1.0D AS t")), "rows")
    before = _stages(spark, "boost"), _stages(spark, "residuals")
    boosting.boost_absolute(df, df, "t", 9, 2, 1)
    assert (_stages(spark, "boost"), _stages(spark, "residuals")) == before


def test_missing_values_are_counted_table_by_table(spark):
    first = spark.createDataFrame([(1, "a"), (None, "a"), (1, None)], "x int, y string")
    second = spark.createDataFrame([(float("nan"),), (-0.0,), (0.0,)], "z double")
    before = _stages(spark, "missing")
    found = profiling.profile_missing({"first": first, "second": second, "absent": None})
    assert len(_stages(spark, "missing") - before) == 2
    assert sorted((r["table"], r["column"], r["missing_count"], r["unique_count"]) for r in found.collect()) == [
        ("first", "x", 1, 1), ("first", "y", 1, 1), ("second", "z", 1, 1)]


def test_the_baseline_keeps_one_copy_of_its_rows(spark, folder):
    before = _stages(spark, "enriched"), _stages(spark, "parts")
    model_queries.QUERIES["baseline_model"](spark, folder).count()
    assert _stages(spark, "enriched") == before[0] and len(_stages(spark, "parts") - before[1]) == 1

"""The two-part model, fitted on the given tables. Boosted trees have no SQL form: rows only."""

from __future__ import annotations

import uuid

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from duewise.functions.expressions import amount_from_log
from duewise.operators import boosting, history, modelling, policy, quantiles, targets
from duewise.queries.shared import (
    SCORED, TGT, credit_table, enriched, enriched_events, scored, shape_ctes, staged, tidy, tidy_sql, with_ctes,
)
from duewise.session import discard, short_methods, stage_dir, staged_folder


def _features(df):
    numeric, text = policy.feature_columns(df.drop("p_cure", "amount_pred"))
    report = policy.apply_column_policy(numeric, text)
    return report.kept_numeric, report.kept_categorical


def _trained(spark, folder, baseline=False):
    data = enriched(spark, folder).drop("p_cure", "amount_pred")
    numeric, text = _features(data)
    return data, modelling.train_hurdle(data, numeric, text, baseline=baseline)


def _rows(spark, pairs):
    return spark.createDataFrame([(k, float(v)) for k, v in pairs if isinstance(v, (int, float)) and v is not None],
                                 "metric string, value double")


def _encoding(spark, folder):
    """Levels of every kept text column: the most frequent first, then by name."""
    joined = staged(history.join_application(enriched_events(spark, folder), credit_table(spark, folder, "application")), "joined")
    numeric, text = _features(joined)
    fitted = modelling.feature_pipeline(numeric, text).fit(modelling.model_inputs(joined, numeric, text))
    out = fitted.transform(modelling.model_inputs(joined, numeric, text))
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}__text").alias("level"), F.col(f"{c}__level").cast("int").alias("code")) for c in text
    ]))
    return out.select(pairs.alias("p")).select("p.*").groupBy("column", "level", "code").agg(F.count(F.lit(1)).alias("rows"))


def _hurdle(spark, folder):
    _, model = _trained(spark, folder, baseline=True)
    return _rows(spark, model.metrics.items())


def _scored_rows(spark, folder):
    data, model = _trained(spark, folder)
    return modelling.score_events(data, model).select(
        "credit_id", "due_day", "number", "p_cure_raw", "p_cure", "amount_pred", "amount_pred_capped", "expected_recovery_model")


def _labelled_rows(events):
    return targets.labelled_events(events.drop("p_cure", "amount_pred")).withColumns({
        "label": F.col("cured_in_horizon"), "amount": F.col("recovered_in_horizon")})


def _split_rows(spark, folder):
    """All columns with label, amount and split, and the features kept, for looking at one part of the model alone."""
    # Written once: beside their place among the rows without a customer, splits are found from the customer alone.
    data = modelling.split_rows(staged(modelling.with_spot(_labelled_rows(enriched_events(spark, folder))), "parts"))
    return data, *_features(data.drop("label", "amount", "split"))


def _parts(spark, folder):
    """The events' keys with vectors of all kept features, label, amount and split."""
    data, numeric, text = _split_rows(spark, folder)
    inputs = modelling.model_inputs(data, numeric, text)
    ready = modelling.feature_pipeline(numeric, text).fit(inputs.where(F.col("split") == "train")).transform(inputs)
    with short_methods(spark):
        return staged(ready.select(*_EVENT, "label", "amount", "split", "features"), "vectors")


def _of(data, split):
    return data.where(F.col("split") == split)


_EVENT = ("credit_id", "due_day", "number")


def _classifier(spark, folder):
    data = _parts(spark, folder)
    return data, modelling.train_cure_model(_of(data, "train"), _of(data, "validation"))


def _cure(spark, folder):
    data, model = _classifier(spark, folder)
    scored_rows = modelling._raw_probability(model, _of(data, "test"))
    return scored_rows.select(*_EVENT, "label", "p_cure_raw", (F.col("p_cure_raw") > 0.5).cast("double").alias("prediction"))


def _amount(spark, folder):
    data = _parts(spark, folder)
    model, _, _ = modelling.train_amount_model(_of(data, "train"), _of(data, "validation"))
    return _of(data, "test").select(*_EVENT, amount_from_log(boosting.score(model)).alias("amount_pred"))


def _calibrated(spark, folder):
    """The fitted classifier's probabilities on the calibration split, before and after."""
    data, model = _classifier(spark, folder)
    raw = staged(modelling._raw_probability(model, _of(data, "calibration")), "raw")
    return modelling._calibrated(raw, modelling.calibrate(raw)).select(*_EVENT, "label", "p_cure_raw", "p_cure")


def _labelled(spark, folder):
    return staged(targets.labelled_events(scored(spark, folder)), "labelled")


def _platt(spark, folder):
    """The curve that calibrates the closed-form score, and whether it is where the gradient vanishes."""
    rows = staged(_labelled(spark, folder).select(F.col("p_cure").alias("p_cure_raw"), F.col("cured_in_horizon").alias("label")), "raw")
    curve = modelling.calibrate(rows)
    at = modelling.platt_gradient(rows, curve.slope, curve.shift)
    small = max(abs(at["g_slope"]), abs(at["g_shift"])) < 1e-6
    row = spark.createDataFrame([(at["n"], curve.slope, curve.shift, small)], "rows long, slope double, shift double, gradient_small boolean")
    return tidy(row, slope=6, shift=6)


def _medians(spark, folder):
    """Quantiles of the amount due per instalment number: what the leaves of the amount model are worth, on given groups."""
    rows = _labelled(spark, folder)
    return tidy(quantiles.grouped_quantiles(rows, "number", "amount_due", [0.5, 0.9]), value=6)


# Three stumps on late rate, partial rate and the full flag: threshold, value up to it, value beyond, weight.
STUMPS = ((0.6, 0.4, -0.3, 1.0), (0.35, 0.25, -0.2, 0.5), (0.5, -0.1, 0.15, 0.5))
_STUMP_COLUMNS = ("hist_late_rate", "hist_partial_rate", "is_full")


def _prefixes(spark, folder):
    """AUC after each tree of a small ensemble that SQL can state."""
    trees = [boosting.Tree([k, -1, -1], [at, 0.0, 0.0], [None] * 3, [1, -1, -1], [2, -1, -1], [0.0, low, high])
             for k, (at, low, high, _) in enumerate(STUMPS)]
    model = boosting.TreeEnsemble(trees, [w for *_, w in STUMPS])
    rows = VectorAssembler(inputCols=list(_STUMP_COLUMNS), outputCol="features").transform(
        _labelled(spark, folder).select(*_STUMP_COLUMNS, F.col("cured_in_horizon").alias("label")))
    found = boosting.prefix_auc(model, rows)
    return tidy(spark.createDataFrame(list(enumerate(found, 1)), "trees int, auc double"), auc=9)


def _baseline(spark, folder):
    # The forest's draws go by the place of a row, which the way rows are written decides; the events go once they are split.
    events = enriched_events(spark, folder)
    written = staged_folder(events, "enriched")
    data = staged(modelling.split_rows(_labelled_rows(spark.read.schema(events.schema).parquet(written))), "parts")
    discard(spark, written)
    numeric, text = _features(data.drop("label", "amount", "split"))
    return modelling.baseline_model(_of(data, "train"), _of(data, "test"), numeric, text).select("label", "p")


def _identities(spark, folder):
    """Scored rows, and how many break what must hold between the columns."""
    rows = _scored_rows(spark, folder)
    held = (F.col("amount_pred_capped") <= F.col("amount_pred") + 1e-9) & F.col("p_cure").between(0, 1)
    product = F.abs(F.col("expected_recovery_model") - F.col("p_cure") * F.col("amount_pred_capped")) < 1e-6
    return rows.groupBy("number").agg(F.count(F.lit(1)).alias("rows"), F.count_if(~(held & product)).alias("broken"))


def _splits(spark, folder):
    """Rows and target rate of the four splits, which the customers' hashes fix."""
    rows = modelling.split_rows(targets.labelled_events(scored(spark, folder)))
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.sum("cured_in_horizon").alias("cured"),
                                     F.countDistinct("customer_id").alias("customers"))


def _reloaded(spark, folder):
    """Scores before and after the model was written and read back: rows and differences."""
    data, model = _trained(spark, folder)
    place = f"{stage_dir(spark)}/model-{uuid.uuid4().hex}"
    modelling.save_model(model, place, spark)
    again = modelling.load_model(place, spark)
    sums = [
        modelling.score_events(data, m).groupBy("number").agg(F.count(F.lit(1)).alias("rows"), F.sum("expected_recovery_model").alias("sum"))
        for m in (model, again)
    ]
    one, two = sums[0], sums[1].select(F.col("number").alias("n2"), F.col("rows").alias("again"), F.col("sum").alias("sum_again"))
    joined = one.join(two, F.col("number").eqNullSafe(F.col("n2")))
    return joined.select("number", "rows", (F.abs(F.col("sum") - F.col("sum_again")) > 1e-6 * F.abs(F.col("sum"))).alias("differs"))


def _policy_report(spark, folder):
    app = credit_table(spark, folder, "application")
    report = policy.apply_column_policy(*policy.feature_columns(app))
    return policy.policy_report(spark, report, {"rows": float(app.count())}, ["trial"]).select(
        "strict_mode", F.size("removed_explicit_columns").alias("removed"), F.size("retained_numeric_columns").alias("numeric"),
        F.size("retained_categorical_columns").alias("categorical"), F.element_at("model_metrics", "rows").alias("rows"))


QUERIES = {
    "train_cure_model": _cure,
    "train_amount_model": _amount,
    "calibrate": _calibrated,
    "calibrate_scorecard": _platt,
    "grouped_medians": _medians,
    "prefix_auc": _prefixes,
    "baseline_model": _baseline,
    "policy_report": _policy_report,
    "categorical_encoding": _encoding,
    "train_hurdle": _hurdle,
    "train_hurdle_splits": _splits,
    "score_events": _scored_rows,
    "score_events_identities": _identities,
    "model_store": _reloaded,
}
_LABELLED = TGT + """,
    lab AS (SELECT * FROM tgt WHERE cured_in_horizon IS NOT NULL),
    cust AS (SELECT customer_id, row_number() OVER (ORDER BY md5('42|' || customer_id), customer_id) AS k, count(*) OVER () AS n
             FROM (SELECT DISTINCT customer_id FROM lab)),
    cut AS (SELECT *, ceil(0.25::DOUBLE * n) AS t FROM cust),
    cut2 AS (SELECT *, ceil(0.2::DOUBLE * (n - t)) AS c FROM cut),
    cut3 AS (SELECT *, ceil(0.15::DOUBLE * (n - t - c)) AS v FROM cut2),
    part AS (SELECT customer_id, CASE WHEN k <= t THEN 'test' WHEN k <= t + c THEN 'calibration' WHEN k <= t + c + v THEN 'validation'
                                      ELSE 'train' END AS split FROM cut3)"""
_M = f"{SCORED}, m AS MATERIALIZED (SELECT * FROM scored WHERE cured_in_horizon IS NOT NULL)"
_STUMP_SCORES = [
    f"CASE WHEN {c} <= {at}::DOUBLE THEN {low}::DOUBLE ELSE {high}::DOUBLE END * {w}::DOUBLE" for c, (at, low, high, w) in zip(_STUMP_COLUMNS, STUMPS)
]
_P_AT = "1 / (1 + exp(-(p_cure * slope + shift)))"
CHECKS = {
    # Newton steps, one per round of the recursion.
    "calibrate_scorecard": tidy_sql(f"""
        WITH RECURSIVE {_M}, g AS (
            SELECT 0 AS k, 0.0::DOUBLE AS slope, 0.0::DOUBLE AS shift
            UNION ALL
            SELECT k + 1, slope - (hb * gs - hab * gb) / (ha * hb - hab * hab), shift - (ha * gb - hab * gs) / (ha * hb - hab * hab)
            FROM (SELECT k, slope, shift, sum((p - y) * x) + slope AS gs, sum(p - y) AS gb, sum(p * (1 - p) * x * x) + 1 AS ha,
                         sum(p * (1 - p) * x) AS hab, sum(p * (1 - p)) AS hb
                  FROM (SELECT k, slope, shift, p_cure AS x, cured_in_horizon AS y, {_P_AT} AS p FROM g, m WHERE k < 15)
                  GROUP BY k, slope, shift)),
        e AS (SELECT slope, shift FROM g WHERE k = 15)
        SELECT count(*) AS rows, slope, shift, abs(sum(({_P_AT} - cured_in_horizon) * p_cure) + slope) < 1e-6
               AND abs(sum({_P_AT} - cured_in_horizon)) < 1e-6 AS gradient_small FROM e, m GROUP BY slope, shift""", slope=6, shift=6),
    "grouped_medians": tidy_sql(with_ctes(_M, """
        SELECT number, q AS probability, CASE q WHEN 0.5 THEN quantile_cont(amount_due, 0.5) ELSE quantile_cont(amount_due, 0.9) END AS value
        FROM m, (SELECT unnest([0.5, 0.9])::DOUBLE AS q) GROUP BY number, q"""), value=6),
    "prefix_auc": tidy_sql(with_ctes(_M + f""",
        s AS (SELECT cured_in_horizon AS y, {_STUMP_SCORES[0]} AS a, {_STUMP_SCORES[1]} AS b, {_STUMP_SCORES[2]} AS c FROM m),
        p AS (SELECT 1 AS trees, y, a AS v FROM s UNION ALL SELECT 2, y, a + b FROM s UNION ALL SELECT 3, y, a + b + c FROM s),
        r AS (SELECT *, row_number() OVER (PARTITION BY trees ORDER BY v) AS i FROM p),
        k AS (SELECT trees, y, avg(i) OVER (PARTITION BY trees, v) AS mid FROM r)""", """
        SELECT trees, (sum(mid) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y)))::DOUBLE AS auc
        FROM k GROUP BY trees"""), auc=9),
    "train_hurdle_splits": with_ctes(_LABELLED, """
        SELECT split, count(*) AS rows, sum(cured_in_horizon)::BIGINT AS cured, count(DISTINCT customer_id) AS customers
        FROM lab JOIN part USING (customer_id) GROUP BY split"""),
    "score_events_identities": with_ctes(TGT, "SELECT number, count(*) AS rows, 0 AS broken FROM tgt GROUP BY number"),
    "model_store": with_ctes(TGT, "SELECT number, count(*) AS rows, false AS differs FROM tgt GROUP BY number"),
    "categorical_encoding": with_ctes(f"{TGT}, {shape_ctes('application')}", """
        SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY rows DESC, level)::INT - 1 AS code FROM (
            SELECT "column", coalesce(level, '__MISSING__') AS level, count(*) AS rows
            FROM (SELECT NAME_INCOME_TYPE, NAME_EDUCATION_TYPE, coalesce(NAME_HOUSING_TYPE, '__MISSING__') AS NAME_HOUSING_TYPE, ORGANIZATION_TYPE
                  FROM tgt LEFT JOIN application USING (customer_id))
            UNPIVOT (level FOR "column" IN (NAME_INCOME_TYPE, NAME_EDUCATION_TYPE, NAME_HOUSING_TYPE, ORGANIZATION_TYPE)) GROUP BY ALL)"""),
    "policy_report": with_ctes(shape_ctes("application") + """,
        c AS (SELECT column_type = 'VARCHAR' AS is_text, column_name IN (
                  'CODE_GENDER', 'DAYS_BIRTH', 'CNT_CHILDREN', 'CNT_FAM_MEMBERS', 'NAME_FAMILY_STATUS') AS gone
              FROM (SUMMARIZE SELECT * FROM application)
              WHERE null_percentage < 100 AND column_name NOT IN ('customer_id', 'TARGET'))""", """
        SELECT true AS strict_mode, count(*) FILTER (gone) AS removed, count(*) FILTER (NOT gone AND NOT is_text) AS numeric,
               count(*) FILTER (NOT gone AND is_text) AS "categorical", (SELECT count(*) FROM application)::DOUBLE AS rows FROM c"""),
}

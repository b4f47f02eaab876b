"""Readers, sampling, sinks and the run summary."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from duewise.operators import decision, modelling, policy, targets
from duewise.plans.flow import RunConfig, run_summary
from duewise.queries.shared import (
    PORTFOLIO, TGT, check_sql, credit_table, credit_tables, portfolio, scored, shape_ctes, tidy, tidy_sql, with_ctes,
    with_targets,
)
from duewise.session import stage_dir
from duewise.sources import readers, sinks
from duewise.sources.schemas import CORE, INSTALMENTS, OPTIONAL, SHORT_NAMES, TABLES

_LONG_NAMES = {v: k for k, v in SHORT_NAMES.items()}


def raw_files(spark, folder, names, fmt="parquet") -> str:
    """The given tables written as files with public names, as a user would bring them."""
    place = f"{stage_dir(spark)}/raw-{uuid.uuid4().hex}"
    for name in names:
        suffix = "csv" if fmt == "csv" else "parquet"
        sinks.write_table(credit_table(spark, folder, name).withColumnsRenamed(_LONG_NAMES),
                          f"{place}/{TABLES[name][0]}.{suffix}", fmt)
    return place


def _scan(spark, folder):
    place = raw_files(spark, folder, ["instalments"], "csv")
    path = readers.resolve_table(spark, place, TABLES["instalments"][0])
    return readers.scan_projected(spark, path, INSTALMENTS).withColumnsRenamed(SHORT_NAMES)


def _counts(tables):
    frames = [df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(df.columns[0]).isNotNull()).alias("keys")).select(
        F.lit(n).alias("name"), "rows", "keys") for n, df in tables.items() if df is not None]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _core(spark, folder):
    return _counts(readers.load_core_tables(spark, raw_files(spark, folder, CORE)))


def _optional(spark, folder):
    """All four, and again without one, which must simply be absent."""
    most = [t for t in OPTIONAL if t != "credit_card"]
    return _counts(readers.load_optional_tables(spark, raw_files(spark, folder, OPTIONAL))).unionByName(
        _counts(readers.load_optional_tables(spark, raw_files(spark, folder, most))))


def _modelable(spark, folder):
    path = sinks.write_table(with_targets(spark, folder), f"{stage_dir(spark)}/modelable-{uuid.uuid4().hex}")
    back = spark.read.parquet(path)
    return tidy(back.groupBy("has_future_observation", "cured_in_horizon").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("recovered_in_horizon").alias("recovered")), recovered=1)


def _outputs(spark, folder):
    """The portfolio written as CSV and read back."""
    path = sinks.write_table(portfolio(spark, folder).select("customer_id", "credit_id", "amount_due", "action", "action_cost"),
                             f"{stage_dir(spark)}/outputs-{uuid.uuid4().hex}", "csv")
    schema = "customer_id long, credit_id long, amount_due double, action string, action_cost double"
    return spark.read.schema(schema).option("header", True).csv(path)


def _run_row(spark, folder):
    events = scored(spark, folder)
    decided = decision.portfolio_latest(decision.recommend_actions(events))
    report = policy.apply_column_policy(*policy.feature_columns(events.drop("p_cure", "amount_pred")))
    rows = modelling.split_rows(targets.labelled_events(events)).where("split = 'train'").count()
    return run_summary(
        events, decided, RunConfig(use_optional=False), (len(report.kept_numeric), len(report.kept_categorical)), rows, {})


def _summary(spark, folder):
    return tidy(_run_row(spark, folder).select(
        "n_events", "target_rate", "n_portfolio", "n_features_categorical",
        F.array_contains("quality_warnings", "optional tables left out: fewer signals").alias("warned")), target_rate=9)


def _resolved(spark, folder):
    """Each form of a file name that is looked for, and the rows found behind it."""
    place = f"{stage_dir(spark)}/resolve-{uuid.uuid4().hex}"
    balance = credit_table(spark, folder, "bureau_balance")
    for name, fmt in (("one", "parquet"), ("two.csv", "csv"), ("three.parquet", "parquet"), ("four_2024.parquet", "parquet")):
        sinks.write_table(balance, f"{place}/{name}", fmt)
    frames = []
    for stem in ("one", "two", "three", "four"):
        path = readers.resolve_table(spark, place, stem)
        table = spark.read.parquet(path) if stem == "one" else readers.read_table(spark, path)
        frames.append(table.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(stem).alias("stem"), F.lit(path.rsplit("/", 1)[-1]).alias("found"), "rows"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _report(spark, folder):
    """The run summary written as a JSON report and read back."""
    path = sinks.write_report(_run_row(spark, folder), f"{stage_dir(spark)}/report-{uuid.uuid4().hex}")
    return tidy(spark.read.json(path).select("n_events", "n_portfolio", "target_rate"), target_rate=9)


QUERIES = {
    "resolve_table": _resolved,
    "write_reports": _report,
    "scan_projected": _scan,
    "load_core_tables": _core,
    "load_optional_tables": _optional,
    "sample_relational": lambda s, d: _counts(readers.sample_relational(credit_tables(s, d), 0.25)),
    "write_modelable": _modelable,
    "write_outputs": _outputs,
    "run_summary": _summary,
}

_KEPT = "('0x' || substr(md5(customer_id::VARCHAR), 1, 4))::INT < 16384"
CHECKS = {
    "scan_projected": check_sql("instalments"),
    "load_core_tables": with_ctes(shape_ctes(*CORE), " UNION ALL ".join(
        f"SELECT '{t}' AS name, count(*) AS rows, count(*) AS keys FROM {t}" for t in CORE)),
    "load_optional_tables": with_ctes(shape_ctes("bureau", "bureau_balance", "pos_cash", "credit_card"), " UNION ALL ".join(
        f"SELECT '{t}' AS name, count(*) AS rows, count(*) AS keys FROM {t}"
        for t in ("bureau", "bureau_balance", "pos_cash", "credit_card", "bureau", "bureau_balance", "pos_cash"))),
    "sample_relational": with_ctes(shape_ctes(), " UNION ALL ".join(
        f"SELECT '{t}' AS name, count(*) AS rows, count(*) AS keys FROM {t} WHERE {_KEPT}"
        for t in ("instalments", "application", "previous", "bureau", "pos_cash", "credit_card"))
        + f""" UNION ALL SELECT 'bureau_balance', count(*), count(*) FROM bureau_balance
               WHERE bureau_id IN (SELECT bureau_id FROM bureau WHERE {_KEPT})"""),
    "write_modelable": tidy_sql(with_ctes(TGT, """
        SELECT has_future_observation, cured_in_horizon, count(*) AS rows, sum(recovered_in_horizon) AS recovered
        FROM tgt GROUP BY ALL"""), recovered=1),
    "write_outputs": with_ctes(PORTFOLIO, "SELECT customer_id, credit_id, amount_due, action, action_cost FROM portfolio"),
    "run_summary": tidy_sql(with_ctes(PORTFOLIO, """
        SELECT (SELECT count(*) FROM tgt) AS n_events, (SELECT avg(cured_in_horizon) FROM tgt) AS target_rate,
               (SELECT count(*) FROM portfolio) AS n_portfolio,
               (SELECT count(*) FROM (DESCRIBE SELECT * FROM tgt) WHERE column_type = 'VARCHAR') AS n_features_categorical, true AS warned"""),
        target_rate=9),
    "resolve_table": with_ctes(shape_ctes("bureau_balance"), " UNION ALL ".join(
        f"SELECT '{stem}' AS stem, '{found}' AS found, count(*) AS rows FROM bureau_balance"
        for stem, found in (("one", "one"), ("two", "two.csv"), ("three", "three.parquet"), ("four", "four_2024.parquet")))),
    "write_reports": tidy_sql(with_ctes(PORTFOLIO, """
        SELECT (SELECT count(*) FROM tgt) AS n_events, (SELECT count(*) FROM portfolio) AS n_portfolio,
               (SELECT avg(cured_in_horizon) FROM tgt) AS target_rate"""), target_rate=9),
}

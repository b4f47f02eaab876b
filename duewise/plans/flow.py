"""The whole flow: raw tables to a decided portfolio, a back-test and a contact plan."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duewise import fixed_values as V
from duewise.operators import allocation, backtest, decision, enrichment, history, modelling, policy, targets
from duewise.session import scope
from duewise.sources import readers, sinks


@dataclass
class RunConfig:
    horizon_days: int = V.DEFAULT_HORIZON_DAYS
    sample_share: float | None = None
    min_history: int = V.DEFAULT_MIN_HISTORY
    strict_policy: bool = True
    use_optional: bool = True
    budget: float = 500_000.0
    capacity: int | None = None
    channel_limits: dict[str, int] = field(default_factory=dict)
    per_customer: int | None = 1
    method: str = "optimised"
    simulations: int = 200
    trees: int = 200  # at most; fitting stops early where validation no longer gains
    depth: int = 5


def build_dataset(tables: dict[str, DataFrame | None], config: RunConfig) -> DataFrame:
    """Delinquency events with history, targets and customer features; one lazy plan.

    History and targets share the shuffle on the credit; the customer joins follow.
    """
    prepared = history.prepare_instalments(tables["instalments"])
    hot = history.hot_keys(tables["instalments"], "credit_id")
    events = history.delinquency_events(history.history_features(prepared, hot), config.min_history)
    events = targets.forward_targets(events, config.horizon_days, hot)
    if tables.get("previous") is not None:
        events = history.join_previous(events, tables["previous"])
    if tables.get("application") is not None:
        events = history.join_application(events, tables["application"])
    if config.use_optional:
        events = enrichment.join_parts(events, enrichment.optional_parts(tables))
    return events


def run_summary(
    dataset: DataFrame, portfolio: DataFrame, config: RunConfig, features: tuple[int, int], train_rows: int | None,
    paths: dict[str, str], removed: list[str] | None = None, contacts: int | None = None,
) -> DataFrame:
    """One row: counts, target rate, configuration, paths and warnings about the run's quality."""
    warnings = []
    if config.sample_share is not None:
        warnings.append("sampled customers: good for a trial, not for a final evaluation")
    if not config.use_optional:
        warnings.append("optional tables left out: fewer signals")
    if train_rows is not None and train_rows < 2000:
        warnings.append("few training rows: add data or review the target filters")
    counts = dataset.agg(F.count(F.lit(1)).alias("n_events"), F.avg("cured_in_horizon").alias("target_rate"))
    size = portfolio.agg(F.count(F.lit(1)).alias("n_portfolio"))
    settings = {k: str(v) for k, v in asdict(config).items()}

    def texts(d: dict[str, str]):
        return F.create_map(*[F.lit(x) for kv in d.items() for x in kv]) if d else F.create_map().cast("map<string,string>")

    return counts.withColumn("n_portfolio", size.scalar()).select(
        "*", F.lit(features[0]).alias("n_features_numeric"), F.lit(features[1]).alias("n_features_categorical"),
        F.lit(contacts).cast("long").alias("planned_contacts"),
        F.array(*[F.lit(r) for r in (removed or [])]).cast("array<string>").alias("removed_features"),
        F.array(*[F.lit(w) for w in warnings]).cast("array<string>").alias("quality_warnings"),
        texts(settings).alias("config"), texts(paths).alias("paths"),
    )


def run_collections(spark: SparkSession, raw: str, out: str, config: RunConfig | None = None) -> dict[str, str]:
    """Run everything and return the path of each output. Stages are handed over as written tables.

    What is staged on the way is deleted at the end, also after an error.
    """
    with scope(spark):
        return _run_collections(spark, raw, out, config or RunConfig())


def _run_collections(spark: SparkSession, raw: str, out: str, config: RunConfig) -> dict[str, str]:
    tables = dict(readers.load_core_tables(spark, raw))
    if config.use_optional:
        tables |= readers.load_optional_tables(spark, raw)
    if config.sample_share is not None:
        tables = readers.sample_relational(tables, config.sample_share)

    paths = {"modelable": sinks.write_table(build_dataset(tables, config), f"{out}/modelable")}
    dataset = spark.read.parquet(paths["modelable"])
    if dataset.isEmpty():
        raise ValueError("no delinquency events: check the data or the history needed")

    numeric, text = policy.feature_columns(dataset)
    report = policy.apply_column_policy(numeric, text, config.strict_policy)
    model = modelling.train_hurdle(dataset, report.kept_numeric, report.kept_categorical, config.trees, config.depth)
    modelling.save_model(model, f"{out}/model", spark)

    paths["scored"] = sinks.write_table(modelling.score_events(dataset, model), f"{out}/scored")
    decided = decision.recommend_actions(spark.read.parquet(paths["scored"]))
    decided = decision.add_human_review(decision.add_reason_codes(decided))
    paths["events"] = sinks.write_table(decided, f"{out}/decided_events")
    events = spark.read.parquet(paths["events"])
    paths["portfolio"] = sinks.write_table(decision.sort_ranked(decision.project_outputs(decision.portfolio_latest(events))), f"{out}/portfolio")
    portfolio = spark.read.parquet(paths["portfolio"])

    paths["holdout"] = sinks.write_table(decision.recommend_actions(model.holdout), f"{out}/holdout")
    holdout = spark.read.parquet(paths["holdout"])
    paths |= sinks.write_tables({
        "benchmark": backtest.full_benchmark(holdout, simulations=config.simulations),
        "recovery_curve": backtest.recovery_curve(holdout),
    }, out)

    plan = allocation.plan_contacts(
        portfolio, config.method, budget=config.budget, capacity=config.capacity,
        channel_limits=config.channel_limits, per_customer=config.per_customer,
    )
    paths["plan"] = sinks.write_table(plan.rows, f"{out}/plan")
    paths["plan_summary"] = sinks.write_report(allocation.summary_row(spark, plan.summary), f"{out}/plan_summary")
    paths["policy"] = sinks.write_report(policy.policy_report(spark, report, model.metrics), f"{out}/policy_report")
    numbers = [(k, float(v)) for k, v in model.metrics.items() if isinstance(v, (int, float)) and v is not None]
    paths["metrics"] = sinks.write_table(spark.createDataFrame(numbers, "metric string, value double"), f"{out}/metrics")
    paths["summary"] = f"{out}/run_summary"
    sinks.write_report(
        run_summary(
            dataset, portfolio, config, (len(report.kept_numeric), len(report.kept_categorical)),
            model.metrics.get("n_rows_train"), paths, report.removed_explicit + report.removed_identifier_like,
            plan.summary["contacts"],
        ),
        paths["summary"],
    )
    return paths

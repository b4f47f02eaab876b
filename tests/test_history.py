import pytest
from pyspark.sql import functions as F

from duewise.operators import history, targets
from duewise.session import staged
from duewise.sources.fixtures import credit_table

COLUMNS = "credit_id long, customer_id long, version double, number int, due_day int, pay_day int, instalment double, payment double"


def _same(a, b, keys):
    x = a.select(*sorted(a.columns)).toPandas().sort_values(keys).reset_index(drop=True)
    y = b.select(*sorted(b.columns)).toPandas().sort_values(keys).reset_index(drop=True)
    assert len(x) == len(y)
    for c in x.columns:
        assert (x[c].isna() == y[c].isna()).all(), c
        filled = x[c].notna()
        assert x[c][filled].tolist() == pytest.approx(y[c][filled].tolist(), rel=1e-9, abs=1e-6), c


def test_prepare_edge_cases(spark):
    rows = [
        (1, 9, 1.0, 1, -100, -95, 100.0, 98.0),   # late, just full
        (1, 9, 1.0, 2, -70, None, 100.0, None),   # unpaid
        (1, 9, 1.0, 3, -40, -50, 0.0, 20.0),      # nothing was due
        (1, 9, 1.0, 4, -10, -10, 10.0, 900.0),    # ratio is capped
    ]
    out = history.prepare_instalments(spark.createDataFrame(rows, COLUMNS)).orderBy("number").collect()
    assert [r["days_past_due"] for r in out] == [5, None, 0, 0]
    assert [r["is_late"] for r in out] == [1, 0, 0, 0]
    assert [r["payment_ratio"] for r in out] == [0.98, 0.0, 0.0, 5.0]
    assert [r["is_full"] for r in out] == [1, 0, 0, 1]
    assert out[1]["severity"] == 0 and out[2]["overpay_amount"] == 20.0 and out[2]["days_before_due"] == 10


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="payment"):
        history.prepare_instalments(spark.createDataFrame([(1,)], "credit_id long"))


def test_history_null_rules(spark):
    rows = [(1, 9, 1.0, n, -100 + 10 * n, (-100 + 10 * n + d) if d is not None else None, 100.0, 50.0)
            for n, d in enumerate([7, None, 3, 0], start=1)]
    out = history.history_features(history.prepare_instalments(spark.createDataFrame(rows, COLUMNS))).orderBy("number").collect()
    assert [r["hist_count"] for r in out] == [0, 1, 2, 3]
    assert [r["hist_dpd_mean"] for r in out] == pytest.approx([None, 7.0, 3.5, 10 / 3])
    assert [r["hist_dpd_max"] for r in out] == [None, 7, None, 7]      # null right after an unknown value
    assert [r["hist_unpaid_sum"] for r in out] == [0.0, 50.0, 100.0, 150.0]
    assert [r["roll3_unpaid_sum"] for r in out] == [None, 50.0, 100.0, 150.0]
    assert [r["roll3_dpd_mean"] for r in out] == [None, 7.0, 7.0, 5.0]


def test_long_credits_take_the_chunked_path_with_equal_results(spark, folder):
    prepared = staged(history.prepare_instalments(credit_table(spark, folder, "instalments")), "prepared")
    keys = ["credit_id", "due_day", "number", "instalment"]
    plain = staged(history.history_features(prepared, None), "plain")
    _same(plain, history.history_features(prepared, hot_rows=15, chunk_rows=7), keys)
    _same(targets.forward_targets(plain, 180, None), targets.forward_targets(plain, 180, hot_rows=15, chunk_rows=8), keys)


def test_targets(spark):
    rows = [(1, 0, 1, 100.0, 0.0, 0.0, 5), (1, 30, 2, 100.0, 120.0, 1.2, 10), (1, 55, 3, 100.0, 40.0, 0.4, 0), (1, 500, 4, 80.0, 80.0, 1.0, 0)]
    events = spark.createDataFrame(rows, "credit_id long, due_day int, number int, instalment double, payment double, payment_ratio double, days_past_due int")
    events = events.withColumn("version", F.lit(1.0)).withColumn("pay_day", F.col("due_day"))
    out = targets.forward_targets(events).orderBy("number").collect()
    assert [r["cured_in_horizon"] for r in out] == [1, 0, None, None]
    assert [r["recovered_in_horizon"] for r in out] == [140.0, 40.0, None, None]
    assert [r["has_future_observation"] for r in out] == [1, 1, 0, 0]


def test_duplicate_previous_rows_do_not_multiply_events(spark):
    events = spark.createDataFrame([(1, 9, 5.0), (2, 9, 6.0)], "credit_id long, customer_id long, AMT_CREDIT double")
    previous = spark.createDataFrame(
        [(1, 9, 7.0), (1, 9, 7.5), (2, 8, 1.0)], "credit_id long, customer_id long, AMT_CREDIT double")
    out = history.join_previous(events, previous).orderBy("credit_id").collect()
    # Credit 2 belongs to another customer there, so nothing is joined.
    assert [(r["AMT_CREDIT"], r["AMT_CREDIT_prev"]) for r in out] == [(5.0, 7.0), (6.0, None)]


def test_joining_previous_adds_no_shuffle_of_events(spark, folder):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        prepared = history.prepare_instalments(credit_table(spark, folder, "instalments"))
        events = history.delinquency_events(history.history_features(prepared, None))
        plan = history.join_previous(events, credit_table(spark, folder, "previous"))
        text = plan._jdf.queryExecution().executedPlan().toString()
        # One for the history, one for making previous unique; none for the join.
        assert text.count("Exchange hashpartitioning(credit_id") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_history_and_targets_share_one_shuffle(spark, folder):
    prepared = history.prepare_instalments(credit_table(spark, folder, "instalments"))
    plan = targets.forward_targets(history.delinquency_events(history.history_features(prepared, None)), 60, None)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(credit_id") == 1

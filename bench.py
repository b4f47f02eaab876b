"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) is read on local[BENCH_CPUS]. Results go to the no-op
sink, so every row is computed and none reaches the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from duewise.queries import all_queries  # noqa: E402
from duewise.session import local_session  # noqa: E402

HEADLINE = (
    "prepare_instalments", "history_features", "delinquency_events", "forward_targets", "join_application",
    "join_bureau_status", "pos_features", "card_features", "join_optional_outer", "recommend_actions", "reason_codes",
    "portfolio_latest", "metric_auc_gini", "metric_topk_business", "strategy_benchmark", "random_benchmark", "recovery_curve",
    "plan_greedy", "plan_optimised", "profile_missing", "profile_numeric", "key_integrity",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cores=os.environ.get("BENCH_CPUS", "8"))
    queries, took = all_queries(), {}
    # One untimed pass over a small aggregate brings up the JVM's code paths.
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderstatus").count().collect()
    for name in names:
        started = time.time()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - started, 3)
        print(f"{name:28s} {took[name]:8.2f}s", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline queries, total wall-clock", "value": round(sum(took.values()), 3), "unit": "sec",
        "queries": took, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

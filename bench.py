"""Time the headline queries and print one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, optional).  Each query is run to completion through
the ``noop`` sink (full execution, nothing collected); one warm-up query runs
first so JVM start-up is not charged to a query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablelens.plans.registry import all_queries  # noqa: E402
from tablelens.session import get_spark  # noqa: E402

HEADLINE = [
    "profile_by_segment",
    "missing_severity",
    "split_stratified",
    "threshold_sweep",
    "metrics_by_model",
    "classification_report",
    "leaderboard",
    "diagnose_runs",
    "plan_steps",
    "similar_datasets_top3",
    "history_votes",
    "last_runs_per_dataset",
    "knn_vote",
    "impute_median",
    "evaluation_summary",
    "order_candidates",
    "model_logistic",
    "model_random_forest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = get_spark(f"local[{cpus}]", app="tablelens-bench", shuffle_partitions=max(cpus * 2, 8))
    qs = all_queries()
    qs["class_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    timings = {}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()

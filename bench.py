"""Seconds per headline query, as one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and BENCH_RUNS
(default 3) set the data, the cores and the timed runs per query after one warm-up
run. Every query runs to the end over whole tables; its rows go to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from riskflow import build_session
from riskflow.plans.shared import drop_intermediates
from riskflow.queries import registered

HEADLINE = (
    "scan_select",
    "write_readback",
    "feature_key_check",
    "any_positive",
    "positive_rate",
    "drop_missing",
    "reduction_summary",
    "null_profile",
    "profile_numeric",
    "value_counts",
    "group_quantiles",
    "leakage_report",
    "label_encode",
    "label_encode_shuffled",
    "one_hot_drop_first",
    "frequency_encode",
    "impute_mean",
    "impute_group_median",
    "standardize",
    "split_counts",
    "split_stratified",
    "class_weight",
    "sample_n",
    "metrics_by_status",
    "roc_curve",
    "roc_auc",
    "sliced_accuracy",
    "latest_per_key",
    "best_run",
    "linear_attribution",
    "kernel_shap_linear",
    "train_logistic",
    "score_batch",
    "stream_score",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = sys.argv[1:] or HEADLINE
    spark = build_session(
        "riskflow-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__sql__files__openCostInBytes=1 << 20,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalogue = registered()
    seconds: dict[str, float] = {}
    for name in chosen:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            catalogue[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    drop_intermediates(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds, median warm run per query",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()

"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the local cores. Every result
is written in full to Spark's ``noop`` sink, so no row goes through the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tabprep.plans.registry import QUERIES  # noqa: E402
from tabprep.session import build_session  # noqa: E402

HEADLINE = [
    "clean_currency",
    "filter_price_range",
    "listing_pipeline",
    "employee_pipeline",
    "dedup_rows",
    "csv_multiline_scan",
    "schema_evolution",
    "profile_describe",
    "profile_summary",
    "null_profile",
    "median_exact",
    "histogram",
    "group_count_ordered",
    "split_train_val_test",
    "impute_median",
    "impute_mode",
    "string_index_wide",
    "one_hot",
    "ols_onehot",
    "model_comparison",
    "eval_auc",
    "tree_regression",
    "rf_regression",
    "gbt_regression",
    "cv_results",
    "search_trials",
    "label_ranks",
    "csv_quoted_splits",
    "runs_pivot",
    "registry_current_stage",
    "clean_split_fit",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    memory = os.environ.get("BENCH_MEMORY", "12g")
    spark = build_session(
        "bench", f"local[{cpus}]", int(cpus), spark__driver__memory=memory, spark__ui__enabled="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

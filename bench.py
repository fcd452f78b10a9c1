"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1) is the input, ``BENCH_CPUS`` the local cores. Each query runs once
to the end of its plan, after a warm-up query that only starts the JVM and its code cache.
"""

from __future__ import annotations

import json
import os
import time

from respondry.plans.catalogue import QUERIES
from respondry.plans.session import session

HEADLINE = (
    "scan_csv", "scan_csv_folder", "index_by_dictionary", "decide_stream", "roundtrip_parquet", "clean_full", "impute_mode", "impute_mean",
    "index_categories", "one_hot", "standard_scale", "assemble_features", "feature_table",
    "split_assign", "smote_balance", "smote_points", "forest_fit", "score_table", "metric_auc",
    "metrics_multiclass", "roc_curve", "pr_curve", "eval_report", "feature_importance",
    "grid_search", "model_report", "forest_reload", "decide_with_model", "decide_text_input",
    "segment_customers", "segment_stats", "marketing_simulation", "risk_rank", "risk_summary",
    "risk_counts", "risk_marginals", "top_at_risk", "top_at_risk_limit", "score_profile",
    "score_histogram", "risk_correlation", "risk_correlation_nulls", "validate_input", "validation_summary",
    "decide_customers",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["segment_stats"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()

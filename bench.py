"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from salescope.plans.catalog import QUERIES
from salescope.session import get_spark

HEADLINE = [
    "left_join_enrich", "validate_required", "null_profile", "column_audit", "describe_numeric",
    "target_quantiles", "corr_matrix", "explode_counts", "histogram_log_target", "frequency_encode",
    "topn_tag_flags", "preprocess_pipeline", "stratified_split", "kfold_assign", "assemble_features",
    "dual_scale_metrics", "error_by_target_bucket", "error_by_label", "worst_predictions", "segment_stats",
    "cluster_profile", "ols_inference", "baseline_table", "pca_sweep", "random_forest", "kmeans",
    "perm_median_diff", "perm_anova_f", "perm_ols_coef_paid", "bootstrap_median_ci", "bootstrap_coef_stability",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()

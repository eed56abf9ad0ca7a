"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from flowsift.queries import REGISTRY
from flowsift.session import build_session

HEADLINE = [
    "audit_by_file",
    "label_normalize",
    "label_recovery_log",
    "audit_nulls",
    "audit_duplicates",
    "audit_constant_cols",
    "profile_describe",
    "profile_variance",
    "clean_silver",
    "audit_stage_report",
    "sink_partitioned",
    "class_pct",
    "time_daily_pivot",
    "dist_histogram_trim",
    "dist_kde",
    "dist_class_ridge",
    "dist_class_quartiles",
    "dist_box_stats",
    "dist_qq_normal",
    "dist_grid_2d",
    "corr_matrix",
    "sample_fixed_n",
    "sample_stratified_cap",
    "split_stratified",
    "balance_to_median",
    "feat_anova_f",
    "feat_corr_prune",
    "feat_vif_all",
    "feat_gold",
    "pipeline_gold",
    "src_csv_roundtrip",
    "feat_pca_scree",
    "feat_rf_importance",
    "eval_per_class",
    "eval_auc",
    "eval_average_precision",
    "eval_compare_global",
    "bench_amdahl",
    "ml_prepared_sides",
    "ml_rf_predict",
    "ml_gbt_ovr_predict",
]


def forest_fit(spark, folder: str) -> float:
    """Seconds of one fit of 200 trees of depth 10 on all rows of `feat` (not part of the total)."""
    from flowsift.operators import features, training
    from flowsift.queries.views import feat

    names = ["quantity", "price", "discount", "tax", "linenumber", "price_net", "day_of_week"]
    rows = features.assemble(features.label_index(feat(spark, folder), "rarity"), names).select("label_index", "features")
    stored = training.store_for_fit(rows)
    estimator = training.sized_forest(stored, numTrees=200, maxDepth=10, maxBins=16)
    return round(training.fit_timed(estimator, stored)[1], 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "flowsift-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    for name in ("audit_by_file", "dist_class_quartiles", "corr_matrix"):  # JVM warm-up, not timed
        REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in wanted:
        start = time.monotonic()
        REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.monotonic() - start, 3)
    fits = {} if sys.argv[1:] else {"rf_200_trees_depth_10": forest_fit(spark, folder)}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "fits": fits,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()

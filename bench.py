"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskloom.plans import catalog  # noqa: E402
from riskloom.session import local_session  # noqa: E402

HEADLINE = [
    "holdout_split", "stratified_split", "numeric_stats", "target_correlations", "impute_median", "impute_mode", "impute_knn",
    "outlier_iqr", "outlier_iforest", "encode_label", "encode_onehot", "encode_leave_one_out", "encode_tfidf", "encode_lsa",
    "resample_oversample", "resample_smote", "resample_adasyn", "scale_standard", "scale_minmax",
    "encode_word2vec", "encode_row_embedding", "model_logreg", "model_random_forest", "model_gradient_boosting", "model_neural_network", "training_history", "metric_roc_auc", "metric_auprc", "classification_report",
    "decode_trials", "generation_best", "fitness_carry_forward", "score_predict",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = local_session(cpus, "bench")
    catalog.views.apps(spark, sf).write.format("noop").mode("overwrite").save()
    found = catalog.queries()
    seconds = {}
    for name in only or HEADLINE:
        start = time.perf_counter()
        found[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf.rstrip("/").split("sf")[-1],
    }))


if __name__ == "__main__":
    main()

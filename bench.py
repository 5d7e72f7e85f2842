"""Headline queries, timed:  prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).  Each query runs once to warm up and
is then timed; results are written to the no-op sink so that every row is produced.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from plumbline.plans import registry  # noqa: E402
from plumbline.session import get_spark  # noqa: E402

HEADLINE = [
    "eda_findings", "profile_missing", "profile_skew", "profile_cardinality", "find_near_constant", "corr_matrix",
    "find_outliers_iqr", "mutual_information", "describe_table", "group_agg", "join_left", "rank_in_group", "running_median",
    "global_rank", "lookup_longest_prefix", "threshold_sweep", "roc_auc", "average_precision", "calibration_curve",
    "per_class_prf", "roc_ovr", "ml_f1_averages", "regression_metrics", "interval_coverage", "split_stratified",
    "encode_target", "confident_joint", "find_label_issues", "audit_eval", "parse_json_prediction", "tfidf_features",
    "conversations_to_turns", "hdi_interval", "assign_nearest", "adjusted_rand", "dedupe_events", "receipt_revenue",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark("bench", cpus, int(cpus) if cpus.isdigit() else 8)
    registry.load_all()
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        for timed in (False, True):
            start = time.perf_counter()
            registry.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            if timed:
                times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": Path(sf).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()

"""Timed headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (threads), BENCH_RUNS (timed runs, median).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from deskmeter.queries import QUERIES  # noqa: E402
from deskmeter.session import get_session  # noqa: E402

HEADLINE = [
    "clean_categoricals", "sla_breach_flag", "text_features", "log_features_flat", "log_features_nested",
    "fct_tickets", "mart_ticket_decision", "ml_features_inner", "kpi_global", "breach_by_priority",
    "breach_by_all_dims", "risk_queue_50", "confusion_matrix", "dashboard_document_json", "dq_report",
    "dim_product", "onehot_categories", "zscore_numeric", "split_exact", "classification_metrics",
    "roc_auc_exact", "roc_curve", "knn_topk", "knn_topk_blocked", "stream_log_features",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):  # the first run warms up
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        timings[name] = round(statistics.median(taken[1:]), 3)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": Path(folder).name,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

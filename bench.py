"""Times the headline queries and prints one JSON line. BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS configure it;
each query's time is the median of its runs, results being written to Spark's noop sink."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import queries  # noqa: E402
from checks.session import local_session  # noqa: E402

HEADLINES = (
    "B1_parse_messages", "B9_format_reading", "B11_rule_score", "D0_severity_counts", "D4_kpis",
    "D5_device_stats", "D6_histogram_zscore", "D9_classification_metrics", "D10_auc_roc",
    "D2_anomaly_summary", "E4_training_view", "E6_dashboard_zscore", "E7_eps_features", "E8_fill_gaps",
    "E9_sequences", "F1_recent_anomalies", "J1_fit_temperature", "J8_kmeans_anomalies",
    "J9_forecast_temperature", "J10_forecast_anomalies", "J11_autoencoder_anomalies",
    "J12_isolation_forest", "J13_one_class_boundary", "J14_sequence_anomalies", "S3_anomaly_rates",
)


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    registered = queries.build()

    def run(name: str) -> None:
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    run("D0_severity_counts")  # starts the session's workers
    times = {}
    for name in HEADLINES:
        try:
            times[name] = round(statistics.median(timed(lambda: run(name)) for _ in range(runs)), 3)
        except Exception as e:  # noqa: BLE001
            print(f"{name}: {e}", file=sys.stderr)
            times[name] = None
    total = round(sum(t for t in times.values() if t is not None), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()

"""Time the headline queries and print one JSON line.

Each query is built and fully executed into Spark's ``noop`` sink; the better of two runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from roompulse.plans import registry  # noqa: E402

HEADLINES = [
    "json_parse", "kafka_envelope", "occupancy_exact", "occupancy_approx", "occupancy_stream",
    "locf_merge", "locf_merge_segments", "confusion_counts", "auc_exact", "lr_score_lineitem",
    "lr_train_score", "stream_score", "stream_route", "export_csv_roundtrip", "log_parse_apache2",
    "log_parse_istio_envoy_proxy",
]
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINES
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("roompulse-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    seconds: dict[str, float] = {}
    for name in names:
        for _ in range(RUNS):
            begin = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - begin
            seconds[name] = round(min(took, seconds.get(name, took)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total of the better of two runs",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()

"""Benchmark: run the headline queries on $BENCH_SF_DIR and print one JSON line.

Each query is executed in full through the ``noop`` sink (every row is
computed, nothing is collected to the driver). A small warm-up query runs
first on the smallest tables so that JVM start-up is not charged to the
first query.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "client_features",
    "incidents_clean",
    "incidents_per_year",
    "incidents_by_country_top11",
    "fatalities_by_operator_top10",
    "mean_incidents_by_era_country",
    "email_clean",
    "email_mean_vector",
    "email_vocabulary",
    "ham_organizations",
    "card_standardized",
    "segment_profile",
    "segment_box_stats",
    "classification_report",
    "vector_distances",
    "ledger_sales",
    "ledger_receipts",
    "ledger_stock",
    "card_segments",
    "spam_topics",
    "incidents_before_by_year",
    "catalog_text",
    "ledger_stream",
    "spam_classifier_report",
    "card_pca_variance",
    "card_elbow",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from tavolo.plans.registry import QUERIES
    from tavolo.session import ensure_checkpoint_dir

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("tavolo-bench")
             .config("spark.sql.shuffle.partitions", str(max(8, cpus * 2)))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "16g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)

    # warm-up on the smallest tables (other data, nothing cached): JVM start-up,
    # class loading and code generation are not charged to the first query
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        QUERIES["client_features"](spark, warm).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for n in names:
        t0 = time.time()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
        print(f"{n}: {times[n]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

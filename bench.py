"""Benchmark: headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS], one JSON line.

Each query is built and run to completion into a sink that discards rows, so
every output column is computed. The first query runs once untimed to start the
JVM's code paths. Names given as arguments replace the headline list.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tierstone.session import local_session
from tierstone.workload.queries import QUERIES

HEADLINE = (
    "flagship_business_monthly",
    "category_city_yearly",
    "customer_cohort_retention",
    "pit_join_two_dims",
    "tip_tiers_documents",
    "event_time_features",
    "scd2_customer_history",
    "scd2_merge_snapshots",
    "upsert_partitioned_reviews",
    "silver_review_features",
    "dedup_latest_lineitem",
    "pit_join_lineitem_supplier",
    "fk_flag_reject_tagging",
    "rank_by_value_counts",
    "nation_month_revenue_windows",
    "ingestion_run_metrics",
    "quality_column_tests",
    "text_features_documents",
    "bronze_json_roundtrip",
    "partitioned_clustered_roundtrip",
)


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, app="tierstone-bench")
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    run(spark, names[0], sf_dir)
    seconds = {name: round(run(spark, name, sf_dir), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()

"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from tidemark import get_session
from tidemark.workload import QUERIES

HEADLINES = [
    "gone_rate_by_day",
    "label_view",
    "label_rate_by_day",
    "main_table",
    "gone_rate_by_event_geo_days_date",
    "performer_counts",
    "performer_bin_events",
    "rate_by_days_bin",
    "five_way_join",
    "counts_beside_rows",
    "lumped_brands",
    "first_seen_customers",
    "insert_absent_customers",
    "parsed_listings",
    "parsed_splits",
    "parsed_events",
    "auc_by_model",
    "roc_points",
    "threshold_sweep",
    "model_comparison",
    "price_quartiles",
    "stratified_fold_sizes",
    "performer_columns",
    "feature_matrix_rows",
    "linear_discriminant",
    "quadratic_discriminant_scores",
    "logistic_variants",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["event_row_count"](spark, folder).collect()
    seconds = {}
    for name in HEADLINES:
        start = time.perf_counter()
        # Every row is produced and none is sent to the driver.
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

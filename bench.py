"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from tidemart.registry import QUERIES
from tidemart.session import build_session

HEADLINE = [
    "revenue_by_month", "distributed_state_revenue", "payment_type_ratio",
    "top10_sellers_each_year", "logistics_freight_cost_analysis",
    "logistics_order_processing_time", "mkt_customer_segmentation_by_geo",
    "mkt_peak_purchase_times_analysis", "churn_features", "user_item_interactions",
    "product_reviews", "cf_user_features", "cf_product_features", "cf_interaction_table",
    "product_content_features", "customer_content_features", "satisfaction_labels", "dq_report",
    "scd2_history", "event_sessions", "summarise_reviews", "slope_one", "knn_items",
]


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", **{
            "spark.sql.shuffle.partitions": str(cpus), "spark.driver.memory": "16g",
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        }
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{root}/orders.parquet").groupBy("o_orderstatus").count().collect()
    times = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({
        "metric": "total wall time of headline queries", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(root.rstrip("/")),
    }))


if __name__ == "__main__":
    main()

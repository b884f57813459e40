"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores; names given on
the command line replace the headline list.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from cartwright.session import build_session
from workbench.queries import QUERIES

HEADLINE = [
    "stg_order_items",
    "stg_payments",
    "stg_events_dedup",
    "stg_products",
    "dedup_first",
    "payments_summary",
    "orders_enriched",
    "customer_orders_summary",
    "price_at_order",
    "fct_orders",
    "fct_events",
    "fct_revenue_daily",
    "fct_revenue_daily_by_return_date",
    "customer_rfm",
    "funnel_conversion",
    "data_quality_audit",
    "return_rate_by_product",
    "gmv_by_period",
    "stg_customers_snapshot",
    "source_checks",
    "incremental_load",
    "upsert_delete_insert",
    "fct_orders_upsert",
    "fct_revenue_daily_incremental",
    "scd2_snapshot",
    "stream_upsert",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        cpus,
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    # One warm-up on the flagship, so that the first query does not pay for
    # starting the JVM's compilers.
    QUERIES["fct_revenue_daily"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale[1]) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local threads), BENCH_RUNS (warm runs per query),
BENCH_QUERIES (comma-separated names; default: the headline list).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tradewind.registry import queries as registry  # noqa: E402
from tradewind.session import build_session  # noqa: E402

HEADLINE = [
    "stg_orders_dedup", "stg_order_items_dedup", "stg_customers_flatten", "order_item_totals",
    "orders_enriched", "customer_metrics", "rfm_segments", "dim_products", "dim_customers",
    "fct_orders", "upsert_orders", "scd2_hard_delete", "scd2_as_of_join", "revenue_by_region_month",
    "dq_revenue_reconciliation", "dq_suite", "stream_dedup_upsert",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES")
    chosen = names.split(",") if names else HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.registered()
    seconds = {}
    for name in chosen:
        taken = []
        for _ in range(runs + 1):
            begin = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - begin)
        # The first run warms up code generation and file listings.
        seconds[name] = round(statistics.median(taken[1:] or taken), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(folder).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

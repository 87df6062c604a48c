"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the test tables and ``BENCH_CPUS`` the local cores. Each query runs to its
end, all rows and columns; the time is the better of ``BENCH_RUNS`` runs and includes any jobs
that planning it starts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ordermill.plans.registry import queries  # noqa: E402
from ordermill.session import local_session  # noqa: E402

OTHERS = [
    "q16b_next_order_by_self_join",
    "clean_orders",
    "clean_products",
    "clean_order_items",
    "items_without_orphans",
    "key_violations",
    "quality_report",
    "period_comparison",
    "period_top_products",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cores)
    spark.sparkContext.setLogLevel("ERROR")
    found = queries()
    names = [n for n in found if n.startswith("q") and n.split("_")[0][1:].isdigit()
             and not n.endswith(("_default", "_double_customers", "_hot_customers"))] + OTHERS
    spark.read.parquet(f"{folder}/orders.parquet").count()
    seconds: dict[str, float] = {}
    for name in names:
        for _ in range(runs):
            begin = time.perf_counter()
            found[name](spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - begin
            seconds[name] = round(min(took, seconds.get(name, took)), 3)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

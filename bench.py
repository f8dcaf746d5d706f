"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the sample folder, BENCH_CPUS the local cores. Each query runs to
a sink that discards its rows; the better of two runs counts, so that neither JVM
start-up nor code generation is measured.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from rentlake.plans.catalogue import QUERIES
from rentlake.session import local_session

HEADLINE = [
    "gold_customer_spend",
    "customer_list",
    "film_list",
    "actor_info",
    "sales_by_store",
    "sales_by_category",
    "rewards_report",
    "customer_balance",
    "film_in_stock",
    "inventory_holder",
    "bronze_ingest",
    "silver_stream_enrich",
    "gold_from_stream",
    "apply_changes",
    "check_pk",
    "check_fk",
    "fk_set_null",
    "table_profile",
    "pivot_sales",
]


def seconds(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    warehouse = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench", **{"spark.sql.warehouse.dir": warehouse})
    best = {name: round(min(seconds(spark, name, folder) for _ in range(2)), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(best.values()), 3),
                "unit": "sec",
                "queries": best,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Times the headline queries and prints one JSON line.

Each query is run once to warm up and then three times; its time is the median. Results go to the
no-op sink, so whole results are computed but not collected. The marts read a star that is stored once; what
building and storing it takes is listed under ``loads`` with two stored loads, each run once, outside the total.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orefold.queries import all_queries  # noqa: E402
from orefold.queries.common import rebuilt_star  # noqa: E402
from orefold.session import create_session  # noqa: E402

HEADLINE = [
    "q01_product_category", "q02_orders_per_customer", "q05_total_revenue", "q06_orders_by_region",
    "q08_top3_customers", "q09_revenue_by_category", "q10_top_discount",
    "top10_customers", "top10_products", "sales_by_category", "sales_by_month", "sales_by_geography",
    "discount_bands", "sales_by_price_range", "v_sales_monthly", "v_customer_performance",
    "bronze_upsert_composite", "scd2_hash", "scd2_hash_composite", "change_feed", "surrogate_keys",
    "dim_product", "dim_customer_scd2", "hierarchy_flatten", "fact_star_lookup", "dq_orphans",
]
REPEATS = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = create_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()

    def run(name: str) -> float:
        started = time.perf_counter()
        registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    def build_star(*_) -> None:
        star = rebuilt_star(spark, folder)
        for table in ("fact", "customer", "geography", "product", "category", "calendar"):
            getattr(star, table)

    loads = {}
    run("q05_total_revenue")
    for name, work in (("star_stored", build_star), ("scd2_stored", lambda: run("scd2_stored")), ("bronze_full_refresh", lambda: run("bronze_full_refresh"))):
        started = time.perf_counter()
        work()
        loads[name] = round(time.perf_counter() - started, 3)
    seconds = {}
    for name in HEADLINE:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(REPEATS)), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "loads": loads, "sf": float(scale) if scale.replace(".", "").isdigit() else scale}))
    spark.stop()


if __name__ == "__main__":
    main()

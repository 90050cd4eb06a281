"""Time the registered questions and a full refresh; prints one JSON line.

Every question is timed from the raw tables on its own: opening the folder,
planning, running and writing every row of the result to a sink that discards it.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyhouse import RetailModel, build_session  # noqa: E402
from tallyhouse.plans.preset import SAMPLE  # noqa: E402
from tallyhouse.plans.refresh import refresh_and_verify  # noqa: E402
from tallyhouse.plans.registry import QUERIES  # noqa: E402
from tallyhouse.session import drop_stages, stage_path  # noqa: E402

HEADLINES = [
    "silver_products",
    "silver_customers",
    "silver_sales",
    "silver_competitor_prices",
    "expectation_report",
    "gold_customer_segments",
    "gold_sales_time",
    "gold_product_sales",
    "gold_sales_detail",
    "gold_price_position",
    "commercial_kpis",
    "daily_revenue_by_channel",
    "weekday_mean_revenue",
    "top_products_filtered",
    "region_category_revenue",
    "best_sellers_by_segment",
    "customer_kpis",
    "top_tier_share",
    "near_vip_customers",
    "price_kpis",
    "price_action_list",
    "above_market_counts",
    "product_sales_with_price_position",
    "quality_suite",
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = sys.argv[1:] or HEADLINES
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> None:
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

    run("gold_sales_time")  # start the JVM's compilers; not counted
    times = {name: timed(lambda: run(name)) for name in chosen}
    if not sys.argv[1:]:
        raw = RetailModel.from_folder(spark, folder).raw
        times["refresh_and_verify"] = timed(lambda: refresh_and_verify(raw, stage_path(spark, "run"), SAMPLE))
    drop_stages(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of headline questions and one full refresh",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

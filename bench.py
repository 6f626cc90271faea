"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up, then $BENCH_RUNS times (5 by default), and the median counts. Results go to the
``noop`` sink, so every row is produced and none is collected. Table layouts are prepared outside the timed part.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from tallyloom.operators import joins, sales  # noqa: E402
from tallyloom.plans import registry  # noqa: E402
from tallyloom.plans.views import transactions  # noqa: E402
from tallyloom.session import build_session, scratch_path  # noqa: E402
from tallyloom.sources import writers  # noqa: E402

registry.load_all()

HEADLINE = [
    "category_revenue",
    "category_performance",
    "customer_value",
    "segment_summary",
    "monthly_trend",
    "city_sales",
    "payment_mix",
    "top_products",
    "monthly_sales_summary",
    "repeat_day_customers",
    "category_revenue_for",
    "word_count",
    "validate",
    "routed_logs",
    "latest_per_key",
    "upsert",
    "apply_cdc",
    "compare",
    "windowed_sales",
    "running_totals",
]


def layouts(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], DataFrame]]:
    """Queries over prepared layouts: partitioned by month, bucketed by customer, and the same rows unbucketed."""
    tx = transactions(spark, sf_dir, ["customer_id", "product_id", "category", "total_amount", "year", "month"])
    plain, by_month, by_customer = (scratch_path(spark, f"bench-{n}") for n in ("plain", "month", "customer"))
    tx.write.parquet(plain)
    writers.write_partitioned(tx, by_month, ["year", "month"])
    writers.write_bucketed(tx, "bench_by_customer", 8, ["customer_id"], by_customer)
    return {
        "category_revenue_for_stored": lambda: sales.category_revenue_for(spark.read.parquet(plain), 1998, [6, 7, 8]),
        "category_revenue_for_partitioned": lambda: sales.category_revenue_for(spark.read.parquet(by_month), 1998, [6, 7, 8]),
        "customer_breadth_stored": lambda: joins.customer_product_breadth(spark.read.parquet(plain)),
        "customer_breadth_bucketed": lambda: joins.customer_product_breadth(spark.table("bench_by_customer")),
    }


def seconds(build: Callable[[], DataFrame], runs: int) -> float:
    def once() -> float:
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    once()
    return statistics.median(once() for _ in range(runs))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {name: seconds(lambda q=registry.QUERIES[name]: q(spark, sf_dir), runs) for name in HEADLINE}
    timings |= {name: seconds(build, runs) for name, build in layouts(spark, sf_dir).items()}
    result = {
        "metric": "sum of query medians",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": {name: round(t, 3) for name, t in timings.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "cpus": cpus,
        "runs": runs,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()

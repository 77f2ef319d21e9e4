"""Times the headline queries and prints one JSON line.

Each query is written to the ``noop`` sink: one warm-up pass over all queries, then the
median of three runs of each.
``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the tables and the number of local cores.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession

from tillroll.plans.catalog import QUERIES
from tillroll.sources.session import release_scratch

HEADLINE = [
    "sales_by_status",
    "top_products",
    "score_distribution",
    "top_customers",
    "monthly_sales",
    "order_metrics",
    "order_metrics_no_fanout",
    "consolidated",
    "order_sales",
    "product_counts",
    "distinct_products",
    "price_stats",
    "top_items_by_price",
    "flatmap_ids",
    "join_inner",
    "label_distribution",
    "profile_by_status",
]
LEARNING = ["ml_scaled_features", "lr_metrics", "cluster_profile"]
RUNS = 3


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tillroll-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def seconds(spark: SparkSession, name: str, folder: str) -> float:
    """One run, building the query included, as fits run there, and without what the runs
    before have left in the scratch folder."""
    release_scratch(spark)
    start = time.perf_counter()
    drain(QUERIES[name](spark, folder))
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    names = [*HEADLINE, *LEARNING]
    for name in names:
        seconds(spark, name, folder)
    queries = {
        name: round(statistics.median(seconds(spark, name, folder) for _ in range(RUNS)), 3)
        for name in names
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

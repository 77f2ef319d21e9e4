"""spark-submit retail_batch.py ORDERS_CSV ITEMS_CSV REVIEWS_CSV OUTPUT [--buckets N [--tables NAMES]]

Session settings (master, memory, shuffle partitions) come from spark-submit.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tillroll.plans.batch import run
from tillroll.sources.sinks import sink_manifest


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    for name in ("orders", "items", "reviews", "output"):
        parser.add_argument(name)
    parser.add_argument("--buckets", type=int, help="store the inputs in N buckets by order")
    parser.add_argument(
        "--tables", default="{}_by_order", help="names of the bucketed tables, {} being the input"
    )
    given = parser.parse_args()
    spark = SparkSession.builder.appName("retail-batch").getOrCreate()
    try:
        run(
            spark, given.orders, given.items, given.reviews, given.output, given.buckets,
            given.tables,
        ).show()
        for table in ("consolidated", "order_metrics"):
            sink_manifest(spark, f"{given.output}/{table}").show(truncate=False)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()

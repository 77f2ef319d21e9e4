"""The whole batch: from the three CSV inputs to stored reports and learning results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import grouping, ranking
from tillroll.operators.joins import TARGET
from tillroll.plans import reports, satisfaction, segments
from tillroll.sources import readers, schemas, sinks

TOP = 10
INPUTS = {"orders": schemas.ORDERS, "items": schemas.ITEMS, "reviews": schemas.REVIEWS}
KEY = "order_id"


def land(
    spark: SparkSession,
    paths: dict[str, str],
    output: str,
    buckets: int | None = None,
    names: str = "{}_by_order",
    bucket_rows: int = TARGET.rows,
) -> dict[str, DataFrame]:
    """Converts the CSV inputs to Parquet once; every later step reads columns from there.

    With ``buckets`` the tables are also shuffled by order once, here, and no report
    shuffles items, orders or reviews again. They are saved under ``names``, which may give
    a database. An order with more than ``bucket_rows`` rows in a table would fill one
    bucket, so it is refused with an error; rows without an order are the same.
    """
    landed = {}
    for name, schema in INPUTS.items():
        # Only reviews hold free text with line breaks, which keep a file in one task.
        table = readers.read_csv_typed(spark, paths[name], schema, multi_line=name == "reviews")
        path = sinks.write_parquet(table, f"{output}/{name}")
        landed[name] = readers.read_parquet(spark, path)
    if buckets is None:
        return landed
    for name, table in landed.items():
        largest = table.groupBy(KEY).count().agg(F.max("count")).first()[0] or 0
        if largest > bucket_rows:
            raise ValueError(
                f"one order fills {largest} rows of {name}; run without buckets to spread it"
            )
    return {
        name: sinks.write_bucketed(
            table, names.format(name), f"{output}/{name}_by_order", KEY, buckets
        )
        for name, table in landed.items()
    }


def run_reports(tables: dict[str, DataFrame], output: str) -> None:
    """Stores the business reports, the consolidated table and the order metrics."""
    orders, items, reviews = tables["orders"], tables["items"], tables["reviews"]
    sales = grouping.sum_per_key(items, KEY, "price + freight_value", "sale_total")
    results = {
        "sales_by_status": reports.sales_by_status(orders, items),
        "top_products": reports.top_products(items, TOP),
        "score_distribution": reports.score_distribution(reviews),
        "top_customers": reports.top_customers(orders, items, TOP),
        "monthly_sales": reports.monthly_sales(orders, items),
        "price_stats": grouping.numeric_summary(items, "price"),
        "top_orders": ranking.top_k(sales, "sale_total", TOP, [KEY]),
        "consolidated": reports.consolidated(orders, items, reviews),
        "order_metrics": reports.order_metrics(orders, items, reviews),
    }
    for name, result in results.items():
        sinks.write_parquet(result, f"{output}/{name}")


def run_learning(spark: SparkSession, output: str) -> DataFrame:
    """Stores predictions, clusters and their profile, and returns a one-row summary."""
    metrics = readers.read_parquet(spark, f"{output}/order_metrics")
    run = satisfaction.fit_satisfaction(satisfaction.labelled_metrics(metrics))
    sinks.write_parquet(run.prediction_report(), f"{output}/predictions")
    sinks.write_parquet(run.coefficients(spark), f"{output}/coefficients")

    segmentation = segments.fit_segments(satisfaction.clean_metrics(metrics))
    assigned = segmentation.assignments().drop("scaled_features")
    sinks.write_parquet(assigned, f"{output}/clusters")
    sinks.write_parquet(segmentation.silhouettes(spark), f"{output}/silhouettes")
    sinks.write_parquet(segmentation.centers(spark), f"{output}/cluster_centers")
    profile = segments.cluster_profile(readers.read_parquet(spark, f"{output}/clusters"))
    sinks.write_parquet(profile, f"{output}/cluster_profile")

    scores = run.metrics()
    best_k, silhouette, _ = segmentation.best
    n_clusters = readers.read_parquet(spark, f"{output}/cluster_profile").count()
    return spark.createDataFrame(
        [(scores["auc"], scores["accuracy"], scores["majority_share"], best_k, silhouette,
          n_clusters)],
        "auc double, accuracy double, majority_share double, best_k int, silhouette double, "
        "n_clusters int",
    )


def run(
    spark: SparkSession,
    orders: str,
    items: str,
    reviews: str,
    output: str,
    buckets: int | None = None,
    names: str = "{}_by_order",
) -> DataFrame:
    """All stages; ``output`` is a folder that every node of the cluster can reach."""
    paths = {"orders": orders, "items": items, "reviews": reviews}
    run_reports(land(spark, paths, output, buckets, names), output)
    summary = run_learning(spark, output)
    sinks.write_parquet(summary, f"{output}/summary")
    return summary

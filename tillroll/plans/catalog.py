"""Every operator and report bound to the star schema tables, by name.

Each entry takes a session and the folder of the tables and reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import checking, clustering, evaluation, features, grouping, inspection
from tillroll.operators import joins, ranking, rows, timelines, totals
from tillroll.plans import reports, satisfaction, segments
from tillroll.sources import readers, schemas, sinks
from tillroll.sources.session import exists, file_stamps, register_views, shared_folder
from tillroll.sources.warehouse import (
    events_view,
    items_view,
    orders_view,
    retail_tables,
    reviews_view,
)

Query = Callable[[SparkSession, str], DataFrame]

PREMIUM_PRICE = 50_000
SESSION_GAP = 1_800
# Stand-ins for fitted centres and rules, so that assignment and scores can be checked in SQL.
FIXED_CENTERS = [(50_000.0, 20.0, 1.0), (150_000.0, 75.0, 3.0), (300_000.0, 150.0, 6.0)]
RULE_ITEMS = 4
# Few enough rows and pairs that the test tables have orders beyond them.
SMALL_TARGET = joins.Target(rows=4, pairs=6)
PLANTED_STEPS = [1e9, 1e6, 1e4]
SCALED_NAMES = ["z_spend", "z_freight", "z_items", "z_status"]


# Sources and sinks


def scan_text_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the orders as CSV text; each file's header line is a row, removed here."""
    orders = orders_view(spark, folder)
    path = sinks.write_csv(orders, shared_folder(spark, "orders-csv"))
    lines = readers.read_text_lines(spark, path)
    return lines.where(F.col("value") != ",".join(orders.columns))


def scan_csv_inferred(spark: SparkSession, folder: str) -> DataFrame:
    path = sinks.write_csv(orders_view(spark, folder), shared_folder(spark, "orders-csv"))
    return readers.read_csv_inferred(spark, path).select(
        F.col("order_id").cast("bigint").alias("order_id"),
        F.col("customer_id").cast("bigint").alias("customer_id"),
        "order_status",
        F.col("order_purchase_timestamp").cast("string").alias("order_purchase_timestamp"),
    )


def scan_csv_typed(spark: SparkSession, folder: str) -> DataFrame:
    """Items hold no line breaks, so their files can be split."""
    path = sinks.write_csv(items_view(spark, folder), shared_folder(spark, "items-csv"))
    return readers.read_csv_typed(spark, path, schemas.ITEMS, multi_line=False)


def scan_csv_free_text(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents as review comments: quotes, commas and line breaks survive CSV."""
    texts = spark.read.parquet(f"{folder}/documents.parquet").select(
        F.col("doc_id").alias("review_id"),
        F.col("doc_id").alias("order_id"),
        (F.col("n_chars") % 5 + 1).alias("review_score"),
        F.col("source").alias("review_comment_title"),
        F.col("text").alias("review_comment_message"),
        F.lit(None).cast("string").alias("review_creation_date"),
        F.lit(None).cast("string").alias("review_answer_timestamp"),
    )
    path = sinks.write_csv(texts, shared_folder(spark, "reviews-csv"))
    return readers.read_csv_typed(spark, path, schemas.REVIEWS).select(
        "review_id", "review_score", "review_comment_title", "review_comment_message"
    )


def parquet_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return stored_metrics(spark, folder)


def parquet_roundtrip_consolidated(spark: SparkSession, folder: str) -> DataFrame:
    frame = consolidated(spark, folder)
    path = sinks.write_parquet(frame, shared_folder(spark, "consolidated"))
    return readers.read_parquet(spark, path)


def sink_manifest(spark: SparkSession, folder: str) -> DataFrame:
    path = sinks.write_parquet(
        order_metrics(spark, folder), shared_folder(spark, "order-metrics")
    )
    return sinks.sink_manifest(spark, path)


def sink_manifest_check(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the manifest's files, and whether all have the right names and some bytes."""
    return sink_manifest(spark, folder).agg(
        F.sum("n_rows").alias("n_rows"),
        F.every(F.col("file_name").endswith(".parquet")).alias("all_parquet"),
        F.every(F.col("file_bytes") > 0).alias("all_with_bytes"),
    )


def sink_row_count(spark: SparkSession, folder: str) -> DataFrame:
    return sink_manifest(spark, folder).agg(F.sum("n_rows").alias("n_rows"))


def sql_sales_by_status(spark: SparkSession, folder: str) -> DataFrame:
    """SQL text over registered views."""
    register_views(retail_tables(spark, folder), prefix="retail_")
    return spark.sql(
        """
        SELECT order_status, count(DISTINCT order_id) AS n_orders,
               cast(sum(cast(price AS decimal(14, 2))) AS double) AS sales_total
        FROM retail_orders JOIN retail_items USING (order_id)
        GROUP BY order_status
        """
    )


# Inspection


def table_counts(spark: SparkSession, folder: str) -> DataFrame:
    return grouping.table_counts(retail_tables(spark, folder))


def head_n(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.head(orders_view(spark, folder), 3, ["order_id"])


def first_row(spark: SparkSession, folder: str) -> DataFrame:
    items = items_view(spark, folder)
    return ranking.head(items, 1, ["order_id", "order_item_id", "product_id", *items.columns])


def table_schemas(spark: SparkSession, folder: str) -> DataFrame:
    return inspection.table_schemas(retail_tables(spark, folder))


# Checks before the analysis

KEYS = {"orders": ["order_id"], "items": ["order_id", "order_item_id"], "reviews": ["review_id"]}
NUMERIC = {"items": ["price", "freight_value"], "reviews": ["review_score"]}


def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    """Nulls, quartiles, outliers and repeated keys of orders, items and reviews."""
    return checking.quality_report(retail_tables(spark, folder), KEYS, NUMERIC)


def deduplicated_items(spark: SparkSession, folder: str) -> DataFrame:
    """One item for each order and position: that with the highest price."""
    return checking.deduplicated(items_view(spark, folder), KEYS["items"], ["-price"])


def sales_after_deduplication(spark: SparkSession, folder: str) -> DataFrame:
    """Sales by status over items without repeated rows."""
    return reports.sales_by_status(orders_view(spark, folder), deduplicated_items(spark, folder))


# Events in time


def event_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Browsing sessions: a visitor's events with at most half an hour between them."""
    events = events_view(spark, folder)
    sums = {
        "n_purchases": (F.col("event_type") == "purchase").cast("long"),
        "value_total": F.col("value").cast("decimal(14,2)"),
    }
    found = timelines.sessions(events, "user_id", "ts", SESSION_GAP, sums)
    return found.select(
        "user_id",
        "session",
        F.col("started").cast("string").alias("started"),
        F.col("ended").cast("string").alias("ended"),
        "n_events",
        "n_purchases",
        F.col("value_total").cast("double").alias("value_total"),
    )


def visits_with_last_purchase(spark: SparkSession, folder: str) -> DataFrame:
    """Every event with its visitor's last purchase up to then."""
    events = events_view(spark, folder)
    purchases = events.where("event_type = 'purchase'").select(
        "user_id", "ts", F.col("event_id").alias("last_purchase_id"), F.col("value").alias("last_value")
    )
    found = timelines.with_last_before(
        events.select("event_id", "user_id", "ts"), "user_id", "ts",
        purchases, "user_id", "ts", ["last_purchase_id", "last_value"],
    )
    return found.select("event_id", "user_id", "last_purchase_id", "last_value")


# Rows


def map_price(spark: SparkSession, folder: str) -> DataFrame:
    return rows.project(items_view(spark, folder), "price")


def item_sales_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return rows.keyed_sum(
        items_view(spark, folder), "order_id", ["price", "freight_value"], "sale_total"
    )


def filter_premium(spark: SparkSession, folder: str) -> DataFrame:
    return rows.above(items_view(spark, folder), "price", PREMIUM_PRICE)


def flatmap_ids(spark: SparkSession, folder: str) -> DataFrame:
    return rows.expand_columns(items_view(spark, folder), ["order_id", "product_id"], "id_value")


# Joins


def join_inner(spark: SparkSession, folder: str) -> DataFrame:
    orders = orders_view(spark, folder).select("order_id", "customer_id", "order_status")
    items = items_view(spark, folder).select("order_id", "product_id", "price")
    return joins.inner_join(orders, items, "order_id")


def join_left(spark: SparkSession, folder: str) -> DataFrame:
    orders = orders_view(spark, folder).select("order_id", "order_status")
    reviews = reviews_view(spark, folder).select("order_id", "review_id", "review_score")
    return joins.left_join(orders, reviews, "order_id")


def consolidated(spark: SparkSession, folder: str) -> DataFrame:
    return reports.consolidated(**retail_tables(spark, folder))


def consolidated_spread(spark: SparkSession, folder: str) -> DataFrame:
    """The consolidated table with a target so small that many orders are spread."""
    return reports.consolidated(**retail_tables(spark, folder), target=SMALL_TARGET)


# Aggregations and ordered heads


def product_counts(spark: SparkSession, folder: str) -> DataFrame:
    return grouping.count_per_key(items_view(spark, folder), "product_id", name="n_sold")


def order_sales(spark: SparkSession, folder: str) -> DataFrame:
    items = items_view(spark, folder)
    return grouping.sum_per_key(items, "order_id", "price + freight_value", "sale_total")


def price_stats(spark: SparkSession, folder: str) -> DataFrame:
    return grouping.numeric_summary(items_view(spark, folder), "price")


def distinct_products(spark: SparkSession, folder: str) -> DataFrame:
    return grouping.distinct_values(items_view(spark, folder), "product_id")


def top_items_by_price(spark: SparkSession, folder: str) -> DataFrame:
    items = items_view(spark, folder).select("product_id", "price")
    return ranking.top_k(items, "price", 10, ["product_id"])


def top_orders(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.top_k(order_sales(spark, folder), "sale_total", 5, ["order_id"])


def top_product_counts(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.top_k(product_counts(spark, folder), "n_sold", 10, ["product_id"])


# Reports


def sales_by_status(spark: SparkSession, folder: str) -> DataFrame:
    return reports.sales_by_status(orders_view(spark, folder), items_view(spark, folder))


def top_products(spark: SparkSession, folder: str) -> DataFrame:
    return reports.top_products(items_view(spark, folder))


def score_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return reports.score_distribution(reviews_view(spark, folder))


def top_customers(spark: SparkSession, folder: str) -> DataFrame:
    return reports.top_customers(orders_view(spark, folder), items_view(spark, folder))


def avg_ticket_per_order(spark: SparkSession, folder: str) -> DataFrame:
    return reports.avg_ticket_per_order(orders_view(spark, folder), items_view(spark, folder))


def monthly_sales(spark: SparkSession, folder: str) -> DataFrame:
    return reports.monthly_sales(orders_view(spark, folder), items_view(spark, folder))


def order_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return reports.order_metrics(**retail_tables(spark, folder))


def order_metrics_no_fanout(spark: SparkSession, folder: str) -> DataFrame:
    return reports.order_metrics_no_fanout(**retail_tables(spark, folder))


MONEY = "decimal(14,2)"


def cumulative_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Orders in the order of their dates, with the sales up to each."""
    orders = orders_view(spark, folder).select("order_id", "order_purchase_timestamp")
    sales = orders.join(order_sales(spark, folder), "order_id")
    found = totals.running_totals(
        sales, ["order_purchase_timestamp", "order_id"], {"running_total": F.col("sale_total").cast(MONEY)}
    )
    return found.withColumn("running_total", F.col("running_total").cast("double"))


def sales_cube(spark: SparkSession, folder: str) -> DataFrame:
    """Items and sales by status and month, by either, and in all."""
    orders = orders_view(spark, folder).select(
        "order_id", "order_status", F.substring("order_purchase_timestamp", 1, 7).alias("month")
    )
    items = items_view(spark, folder).select("order_id", "price")
    found = totals.cube(
        items.join(orders, "order_id"), ["order_status", "month"],
        {"n_items": F.lit(1).cast("long"), "sales_total": F.col("price").cast(MONEY)},
    )
    return found.withColumn("sales_total", F.col("sales_total").cast("double"))


def monthly_seasonality(spark: SparkSession, folder: str) -> DataFrame:
    """Trend, seasonal share and residual of the monthly sales, to six digits."""
    monthly = monthly_sales(spark, folder).select("month", "sales_total")
    found = totals.with_seasons(monthly, "month", "sales_total")
    return found.select(
        "month", F.round("sales_total", 2).alias("sales_total"), F.round("trend", 2).alias("trend"),
        F.round("seasonal", 6).alias("seasonal"), F.round("residual", 6).alias("residual"),
    )


# Learning. Each run starts from order metrics stored as Parquet: fitting reads its input
# many times, and files cut the lineage back to the joins.


def stored_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Order metrics from storage, written once for the tables of a folder in a session.

    They are written again if a table's files have changed.
    """
    metrics = order_metrics(spark, folder)
    source = (spark.sparkContext.applicationId, folder, file_stamps(spark, metrics.inputFiles()))
    path = _WRITTEN.get(source)
    if path is None or not exists(spark, path):
        path = sinks.write_parquet(metrics, shared_folder(spark, "order-metrics"))
        _WRITTEN[source] = path
    return readers.read_parquet(spark, path)


_WRITTEN: dict[tuple, str] = {}


def clean_order_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return satisfaction.clean_metrics(order_metrics(spark, folder))


def label_satisfied(spark: SparkSession, folder: str) -> DataFrame:
    labelled = satisfaction.labelled_metrics(order_metrics(spark, folder))
    return labelled.select("order_id", "avg_score", satisfaction.LABEL)


def label_distribution(spark: SparkSession, folder: str) -> DataFrame:
    labelled = satisfaction.labelled_metrics(order_metrics(spark, folder))
    return satisfaction.label_distribution(labelled)


def split_counts(spark: SparkSession, folder: str) -> DataFrame:
    labelled = satisfaction.labelled_metrics(order_metrics(spark, folder))
    side = F.when(features.on_train_side("order_id"), "train").otherwise("test")
    return grouping.count_per_key(
        labelled.select(side.alias("table_name")), "table_name", name="n_rows"
    )


def ml_status_index(spark: SparkSession, folder: str) -> DataFrame:
    clean = satisfaction.clean_metrics(stored_metrics(spark, folder))
    indexed = features.status_indexer().fit(clean).transform(clean)
    return indexed.select("order_id", "order_status", features.STATUS_INDEX)


def ml_scaled_features(spark: SparkSession, folder: str) -> DataFrame:
    clean = satisfaction.clean_metrics(stored_metrics(spark, folder))
    scaled = features.scaled_features(clean).select("order_id", features.SCALED)
    wide = features.vector_columns(scaled, features.SCALED, SCALED_NAMES)
    # Adding zero turns a rounded -0.0 into 0.0.
    return wide.select(
        "order_id", *((F.round(name, 6) + F.lit(0.0)).alias(name) for name in SCALED_NAMES)
    )


def eval_auc_fixed_score(spark: SparkSession, folder: str) -> DataFrame:
    """The AUC evaluator with an order's spend as score."""
    labelled = satisfaction.labelled_metrics(stored_metrics(spark, folder))
    auc = evaluation.area_under_roc(labelled, satisfaction.LABEL, "spend_total")
    return spark.createDataFrame([(round(auc, 6),)], "auc double")


def eval_accuracy_fixed_rule(spark: SparkSession, folder: str) -> DataFrame:
    """The accuracy evaluator with a rule on the item count as prediction."""
    labelled = satisfaction.labelled_metrics(stored_metrics(spark, folder))
    ruled = rows.label_at_least(labelled, "item_count", RULE_ITEMS, "prediction")
    value = evaluation.accuracy(ruled, satisfaction.LABEL)
    return spark.createDataFrame([(round(value, 6),)], "accuracy double")


def eval_majority_share(spark: SparkSession, folder: str) -> DataFrame:
    labelled = satisfaction.labelled_metrics(stored_metrics(spark, folder))
    value = evaluation.majority_share(labelled, satisfaction.LABEL)
    return spark.createDataFrame([(round(value, 6),)], "majority_share double")


def eval_silhouette_fixed(spark: SparkSession, folder: str) -> DataFrame:
    """The silhouette evaluator with the order status as cluster."""
    clean = satisfaction.clean_metrics(stored_metrics(spark, folder))
    scaled = features.scaled_features(clean).withColumn(
        "prediction", F.col(features.STATUS_INDEX).cast("int")
    )
    value = evaluation.silhouette(scaled)
    return spark.createDataFrame([(round(value, 6),)], "silhouette double")


def kmeans_assign_fixed(spark: SparkSession, folder: str) -> DataFrame:
    """Orders assigned by a model fitted to the fixed centres themselves."""
    schema = ", ".join(f"{name} double" for name in features.NUMERIC_FEATURES)
    assemble = VectorAssembler(inputCols=features.NUMERIC_FEATURES, outputCol=features.SCALED)
    centers = assemble.transform(spark.createDataFrame(FIXED_CENTERS, schema))
    model = clustering.fit_kmeans(centers, len(FIXED_CENTERS))
    clean = assemble.transform(satisfaction.clean_metrics(order_metrics(spark, folder)))
    return clustering.assign_clusters(model, clean).select("order_id", "prediction")


def profile_by_status(spark: SparkSession, folder: str) -> DataFrame:
    clean = satisfaction.clean_metrics(order_metrics(spark, folder))
    return clustering.cluster_profile(clean, "order_status")


def fit_satisfaction(spark: SparkSession, folder: str) -> satisfaction.SatisfactionRun:
    return satisfaction.fit_satisfaction(
        satisfaction.labelled_metrics(stored_metrics(spark, folder))
    )


def lr_coefficients(spark: SparkSession, folder: str) -> DataFrame:
    return fit_satisfaction(spark, folder).coefficients(spark)


def lr_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return fit_satisfaction(spark, folder).prediction_report()


def lr_prediction_sample(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.head(fit_satisfaction(spark, folder).prediction_report(), 10, ["order_id"])


def lr_metrics(spark: SparkSession, folder: str) -> DataFrame:
    scores = fit_satisfaction(spark, folder).metrics()
    return spark.createDataFrame(
        [(scores["auc"], scores["accuracy"], scores["majority_share"])],
        "auc double, accuracy double, majority_share double",
    )


def fit_segments(spark: SparkSession, folder: str) -> segments.Segmentation:
    return segments.fit_segments(satisfaction.clean_metrics(stored_metrics(spark, folder)))


def lr_gradient(spark: SparkSession, folder: str) -> DataFrame:
    """The slopes at the fitted weights to three digits: all zero at the minimum."""
    return fit_satisfaction(spark, folder).gradient().select(
        "position", "feature", (F.round("slope", 3) + F.lit(0.0)).alias("slope"), "n_train"
    )


def lr_report_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The prediction report without the model's own column."""
    return fit_satisfaction(spark, folder).prediction_report().drop("prediction")


def lr_test_share(spark: SparkSession, folder: str) -> DataFrame:
    """Size of the test side, and the share of its majority label from the run's metrics."""
    run = fit_satisfaction(spark, folder)
    share = F.lit(round(run.metrics()["majority_share"], 6))
    return run.test.agg(F.count("*").alias("n_test")).select("n_test", share.alias("majority_share"))


# Planted groups: metrics moved far apart by the order's number, so that the fitted
# clustering has a known answer over whole tables.


def planted_segments(spark: SparkSession, folder: str) -> segments.Segmentation:
    clean = satisfaction.clean_metrics(stored_metrics(spark, folder))
    moved = {
        name: F.col(name) + F.pmod(F.col("order_id"), F.lit(3)) * F.lit(step)
        for name, step in zip(features.NUMERIC_FEATURES, PLANTED_STEPS)
    }
    return segments.fit_segments(clean.withColumns(moved), columns=features.NUMERIC_FEATURES)


def kmeans_planted_best_k(spark: SparkSession, folder: str) -> DataFrame:
    silhouettes = planted_segments(spark, folder).silhouettes(spark)
    return segments.best_of(silhouettes).select("k", F.round("silhouette", 5).alias("silhouette"))


def kmeans_planted_assignments(spark: SparkSession, folder: str) -> DataFrame:
    return planted_segments(spark, folder).assignments().select("order_id", "prediction")


def kmeans_planted_profile(spark: SparkSession, folder: str) -> DataFrame:
    return planted_segments(spark, folder).profile()


def kmeans_planted_centers(spark: SparkSession, folder: str) -> DataFrame:
    centers = planted_segments(spark, folder).centers(spark)
    return centers.select(
        "prediction", *(F.round(name, 5).alias(name) for name in features.NUMERIC_FEATURES)
    )


def ml_summary_check(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the run summary is one row of values in range, its clusters as many as its k."""
    summary = ml_summary(spark, folder)
    share = lambda name: F.col(name).between(0, 1)
    return summary.agg(
        F.count("*").alias("n_rows"),
        F.every(share("auc") & share("accuracy")).alias("scores_in_range"),
        F.every(F.col("best_k").isin(list(clustering.K_RANGE))).alias("k_in_range"),
        F.every(F.col("silhouette").between(-1, 1)).alias("silhouette_in_range"),
        F.every(F.col("n_clusters") == F.col("best_k")).alias("clusters_as_k"),
    )


def kmeans_silhouette_by_k(spark: SparkSession, folder: str) -> DataFrame:
    return fit_segments(spark, folder).silhouettes(spark)


def kmeans_best_k(spark: SparkSession, folder: str) -> DataFrame:
    return segments.best_of(fit_segments(spark, folder).silhouettes(spark))


def kmeans_assignments(spark: SparkSession, folder: str) -> DataFrame:
    return fit_segments(spark, folder).assignments().select("order_id", "prediction")


def cluster_profile(spark: SparkSession, folder: str) -> DataFrame:
    return fit_segments(spark, folder).profile()


def kmeans_centers(spark: SparkSession, folder: str) -> DataFrame:
    return fit_segments(spark, folder).centers(spark)


def ml_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Classifier scores, best k with its silhouette, and the number of clusters found."""
    metrics = stored_metrics(spark, folder)
    labelled = satisfaction.labelled_metrics(metrics)
    scores = satisfaction.fit_satisfaction(labelled).metrics()
    segmentation = segments.fit_segments(satisfaction.clean_metrics(metrics))
    k, silhouette, _ = segmentation.best
    clusters = segmentation.assignments().select("prediction").distinct()
    return clusters.agg(F.count("*").alias("n_clusters")).select(
        F.lit(scores["auc"]).alias("auc"),
        F.lit(scores["accuracy"]).alias("accuracy"),
        F.lit(k).alias("best_k"),
        F.lit(silhouette).alias("silhouette"),
        "n_clusters",
    )


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        scan_text_lines,
        scan_csv_inferred,
        scan_csv_typed,
        scan_csv_free_text,
        parquet_roundtrip,
        parquet_roundtrip_consolidated,
        sink_manifest,
        sink_manifest_check,
        sink_row_count,
        sql_sales_by_status,
        table_counts,
        head_n,
        first_row,
        table_schemas,
        quality_report,
        deduplicated_items,
        sales_after_deduplication,
        event_sessions,
        visits_with_last_purchase,
        map_price,
        item_sales_pairs,
        filter_premium,
        flatmap_ids,
        join_inner,
        join_left,
        consolidated,
        consolidated_spread,
        product_counts,
        order_sales,
        price_stats,
        distinct_products,
        top_items_by_price,
        top_orders,
        top_product_counts,
        sales_by_status,
        top_products,
        score_distribution,
        top_customers,
        avg_ticket_per_order,
        monthly_sales,
        cumulative_sales,
        sales_cube,
        monthly_seasonality,
        order_metrics,
        order_metrics_no_fanout,
        clean_order_metrics,
        label_satisfied,
        label_distribution,
        split_counts,
        ml_status_index,
        ml_scaled_features,
        eval_auc_fixed_score,
        eval_accuracy_fixed_rule,
        eval_majority_share,
        eval_silhouette_fixed,
        kmeans_assign_fixed,
        profile_by_status,
        lr_coefficients,
        lr_predictions,
        lr_prediction_sample,
        lr_metrics,
        lr_gradient,
        lr_report_rows,
        lr_test_share,
        kmeans_planted_best_k,
        kmeans_planted_assignments,
        kmeans_planted_profile,
        kmeans_planted_centers,
        kmeans_silhouette_by_k,
        kmeans_best_k,
        kmeans_assignments,
        cluster_profile,
        kmeans_centers,
        ml_summary,
        ml_summary_check,
    )
}

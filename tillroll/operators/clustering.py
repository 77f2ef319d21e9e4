"""K-means with repeatable placement, search over k, and cluster profiles."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.money import ExactSum
from tillroll.operators.evaluation import silhouette

# The range of k, seed and iteration limit that results are compared at.
K_RANGE = range(2, 7)
SEED = 42
MAX_ITERATIONS = 20

# Partitions of the placed rows, whatever their number; part of the result, so choose it
# once for a corpus, by the memory and cores that are to hold it.
PARTITIONS = 8


def placed_by_key(frame: DataFrame, key: str, partitions: int = PARTITIONS) -> DataFrame:
    """Puts rows into an order that depends on the key alone.

    K-means draws its first centres per partition, so its result follows the placement of
    the rows even with a seed. The number of partitions is fixed, so it depends neither on
    the session nor on the number of rows; ``key`` should be unique, or nearly so.
    """
    return frame.repartition(partitions, key).sortWithinPartitions(key)


def fit_kmeans(frame: DataFrame, k: int, features: str = "scaled_features") -> KMeansModel:
    return KMeans(featuresCol=features, k=k, seed=SEED, maxIter=MAX_ITERATIONS).fit(frame)


def search_k(
    frame: DataFrame,
    ks: Sequence[int] = K_RANGE,
    features: str = "scaled_features",
    parallelism: int = 5,
) -> list[tuple[int, float, KMeansModel]]:
    """Model and silhouette for each k.

    The fits do not depend on each other, so their jobs are submitted side by side; the
    frame should be persisted.
    """
    ks = list(ks)
    if len(ks) == 0:
        return []

    @inheritable_thread_target(frame.sparkSession)
    def one(k: int) -> tuple[int, float, KMeansModel]:
        model = fit_kmeans(frame, k, features)
        return k, silhouette(model.transform(frame), features), model

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(ks)))) as pool:
        return list(pool.map(one, ks))


def best_k(results: Sequence[tuple[int, float, KMeansModel]]) -> tuple[int, float, KMeansModel]:
    """The result with the highest silhouette, and the smallest k among equals."""
    return min(results, key=lambda result: (-result[1], result[0]))


def cluster_ranks(model: KMeansModel) -> list[int]:
    """New number of each cluster: ascending by centre, first coordinate first."""
    centers = [tuple(center) for center in model.clusterCenters()]
    order = sorted(range(len(centers)), key=lambda cluster: centers[cluster])
    return [order.index(cluster) for cluster in range(len(centers))]


def assign_clusters(model: KMeansModel, frame: DataFrame) -> DataFrame:
    """Adds ``prediction``, numbered by :func:`cluster_ranks` and so free of fit order."""
    ranks = F.array(*(F.lit(rank) for rank in cluster_ranks(model)))
    assigned = model.transform(frame)
    return assigned.withColumn("prediction", F.get(ranks, F.col("prediction")))


def cluster_centers(spark: SparkSession, model: KMeansModel, names: Sequence[str]) -> DataFrame:
    """One row per cluster with its centre, numbered as in :func:`assign_clusters`."""
    rows = sorted(
        (rank, *(float(value) for value in center))
        for rank, center in zip(cluster_ranks(model), model.clusterCenters())
    )
    schema = ", ".join(["prediction int", *(f"{name} double" for name in names)])
    return spark.createDataFrame(rows, schema)


# Scores are ratios, so they are added in billionths: the sum is free of row order.
_SCORE_SUM = "sum(cast(rint(avg_score * 1e9d) AS decimal(20, 0))) AS score_units"
_SCORE_MEAN = (
    "cast((2 * score_units + cast(n_scores AS decimal(20, 0)) * 10000000)"
    " div (2 * cast(n_scores AS decimal(20, 0)) * 10000000) AS double) / 100"
)


def cluster_profile(clustered: DataFrame, cluster: str = "prediction") -> DataFrame:
    """Size of each cluster of orders and its mean spend, freight, items and score."""
    spend, freight, items = ExactSum("spend"), ExactSum("freight"), ExactSum("items")
    return (
        clustered.select(
            "*",
            *spend.split("spend_total"),
            *freight.split("freight_total"),
            *items.split("item_count"),
        )
        .groupBy(cluster)
        .agg(
            F.count("*").alias("n_orders"),
            F.count("spend_total").alias("n_spend"),
            *spend.sums(),
            F.count("freight_total").alias("n_freight"),
            *freight.sums(),
            F.count("item_count").alias("n_items"),
            *items.sums(),
            F.count("avg_score").alias("n_scores"),
            F.expr(_SCORE_SUM),
        )
        .select(
            cluster,
            "n_orders",
            spend.mean("n_spend").alias("avg_spend"),
            freight.mean("n_freight").alias("avg_freight"),
            items.mean("n_items").alias("avg_items"),
            F.expr(_SCORE_MEAN).alias("avg_score"),
        )
        .orderBy(cluster)
    )

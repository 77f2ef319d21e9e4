"""Segmentation of orders by k-means."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.clustering import (
    K_RANGE,
    PARTITIONS,
    assign_clusters,
    best_k,
    cluster_centers,
    cluster_profile,
    placed_by_key,
    search_k,
)
from tillroll.operators.features import (
    FEATURE_NAMES,
    SCALED,
    STATUS_INDEX,
    scaled_features,
)
from tillroll.sources.session import persisted


def segment_features(clean: DataFrame, columns: Sequence[str] = FEATURE_NAMES) -> DataFrame:
    """Clean order metrics with their scaled feature vector; fitted on all rows."""
    return scaled_features(clean, columns).drop("features", STATUS_INDEX)


@dataclass(frozen=True)
class Segmentation:
    features: DataFrame
    results: list[tuple[int, float, KMeansModel]]
    columns: Sequence[str] = tuple(FEATURE_NAMES)

    @property
    def best(self) -> tuple[int, float, KMeansModel]:
        return best_k(self.results)

    def silhouettes(self, spark: SparkSession) -> DataFrame:
        rows = [(k, float(value)) for k, value, _ in self.results]
        return spark.createDataFrame(rows, "k int, silhouette double")

    def assignments(self) -> DataFrame:
        """Each order's cluster in the best clustering."""
        return assign_clusters(self.best[2], self.features)

    def profile(self) -> DataFrame:
        return cluster_profile(self.assignments())

    def centers(self, spark: SparkSession) -> DataFrame:
        return cluster_centers(spark, self.best[2], self.columns)


def best_of(silhouettes: DataFrame) -> DataFrame:
    """The row with the highest silhouette, and the smallest k among equals."""
    return silhouettes.orderBy(F.col("silhouette").desc(), "k").limit(1)


def fit_segments(
    clean: DataFrame,
    key: str = "order_id",
    ks: Sequence[int] = K_RANGE,
    partitions: int = PARTITIONS,
    columns: Sequence[str] = FEATURE_NAMES,
) -> Segmentation:
    """Fits k-means for each k on features placed by key.

    Key and vector alone are persisted while fitting, and released before this returns.
    ``clean`` should be read from storage: lost blocks are then rebuilt from files.
    """
    features = segment_features(clean, columns)
    with persisted(placed_by_key(features.select(key, SCALED), key, partitions)) as (kept,):
        results = search_k(kept, ks)
    return Segmentation(features, results, list(columns))

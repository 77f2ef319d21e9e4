"""Scores of predictions and clusterings."""

from __future__ import annotations

from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    ClusteringEvaluator,
    MulticlassClassificationEvaluator,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def area_under_roc(
    predictions: DataFrame, label: str, score: str = "rawPrediction", bins: int = 0
) -> float:
    """Area under the ROC curve of a score or raw prediction column.

    ``bins=0`` keeps every distinct score and is exact. A positive number merges the
    scores into about that many points, which is cheaper where nearly all scores differ.
    """
    return BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=score, metricName="areaUnderROC", numBins=bins
    ).evaluate(predictions)


def accuracy(predictions: DataFrame, label: str, prediction: str = "prediction") -> float:
    return MulticlassClassificationEvaluator(
        labelCol=label, predictionCol=prediction, metricName="accuracy"
    ).evaluate(predictions)


def majority_share(frame: DataFrame, label: str) -> float:
    """Share of the most frequent label, which any model has to beat."""
    counts = frame.groupBy(label).agg(F.count("*").alias("n"))
    return counts.agg(F.max("n") / F.sum("n")).first()[0]


def silhouette(
    clustered: DataFrame, features: str = "scaled_features", prediction: str = "prediction"
) -> float:
    """Mean silhouette under squared Euclidean distance, from per-cluster sums."""
    return ClusteringEvaluator(
        featuresCol=features,
        predictionCol=prediction,
        metricName="silhouette",
        distanceMeasure="squaredEuclidean",
    ).evaluate(clustered)

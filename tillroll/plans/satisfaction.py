"""Satisfaction classification of orders by logistic regression."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.evaluation import accuracy, area_under_roc, majority_share
from tillroll.operators.features import FEATURE_NAMES, SCALED, feature_stages, split_by_key
from tillroll.operators.rows import drop_incomplete, label_at_least
from tillroll.sources.session import persisted

LABEL = "satisfied"
# The columns without which an order is left out.
REQUIRED = ["spend_total", "freight_total", "item_count", "avg_score", "order_status"]

# The satisfaction threshold and model settings results are compared at.
SATISFIED_FROM = 4
MAX_ITERATIONS = 20
REGULARISATION = 0.01


def clean_metrics(metrics: DataFrame) -> DataFrame:
    """Order metrics without rows that lack a needed value."""
    return drop_incomplete(metrics, REQUIRED)


def labelled_metrics(metrics: DataFrame) -> DataFrame:
    """Clean order metrics with the label 1.0 for a mean score of four or more."""
    return label_at_least(clean_metrics(metrics), "avg_score", SATISFIED_FROM, LABEL)


def label_distribution(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy(LABEL).agg(F.count("*").alias("n"))


@dataclass(frozen=True)
class SatisfactionRun:
    model: PipelineModel
    train: DataFrame
    test: DataFrame

    def predictions(self) -> DataFrame:
        """Scored test rows, with the model's columns."""
        return self.model.transform(self.test)

    def prediction_report(self) -> DataFrame:
        return self.predictions().select(
            "order_id", "spend_total", "avg_score", LABEL, "prediction"
        )

    def metrics(self) -> dict[str, float]:
        """AUC and accuracy on the test rows, next to the share of the majority label."""
        scored = self.predictions().select(LABEL, "rawPrediction", "prediction")
        with persisted(scored) as (kept,):
            return {
                "auc": area_under_roc(kept, LABEL),
                "accuracy": accuracy(kept, LABEL),
                "majority_share": majority_share(kept, LABEL),
            }

    def gradient(self) -> DataFrame:
        """Slope of the regularised loss at the fitted weights, one row per weight.

        Near zero in each feature and the intercept if the fit has reached the minimum; with
        the number of training rows.
        """
        fitted = self.model.stages[-1]
        scored = self.model.transform(self.train).select(
            vector_to_array(SCALED).alias("x"),
            (vector_to_array("probability")[1] - F.col(LABEL)).alias("miss"),
        )
        names = [*FEATURE_NAMES, "intercept"]
        means = [F.avg(F.col("miss") * F.col("x")[i]) for i in range(len(FEATURE_NAMES))]
        slopes = [
            mean + REGULARISATION * float(weight)
            for mean, weight in zip(means, fitted.coefficients)
        ] + [F.avg("miss")]
        rows = F.array(
            *(
                F.struct(F.lit(i).alias("position"), F.lit(name).alias("feature"),
                         slope.alias("slope"))
                for i, (name, slope) in enumerate(zip(names, slopes), start=1)
            )
        )
        return scored.agg(F.count("*").alias("n_train"), rows.alias("rows")).select(
            F.inline("rows"), "n_train"
        )

    def coefficients(self, spark: SparkSession) -> DataFrame:
        """The weight of each scaled feature, and the intercept as the last row."""
        fitted = self.model.stages[-1]
        names = [*FEATURE_NAMES, "intercept"]
        weights = [*fitted.coefficients.toArray().tolist(), fitted.intercept]
        rows = [
            (position, name, float(weight))
            for position, (name, weight) in enumerate(zip(names, weights), start=1)
        ]
        return spark.createDataFrame(rows, "position int, feature string, weight double")


def fit_satisfaction(labelled: DataFrame, key: str = "order_id") -> SatisfactionRun:
    """Fits features and classifier on the training side of a split by key.

    ``labelled`` is read once per fitted stage and should come from storage.
    """
    train, test = split_by_key(labelled, key)
    classifier = LogisticRegression(
        featuresCol=SCALED,
        labelCol=LABEL,
        maxIter=MAX_ITERATIONS,
        regParam=REGULARISATION,
    )
    model = Pipeline(stages=[*feature_stages(), classifier]).fit(train)
    return SatisfactionRun(model, train, test)

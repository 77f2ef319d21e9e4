"""Feature preparation and train/test splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, Transformer
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import key_bucket

STATUS_INDEX = "status_index"
# The feature columns that results are compared on.
NUMERIC_FEATURES = ["spend_total", "freight_total", "item_count"]
FEATURE_NAMES = [*NUMERIC_FEATURES, STATUS_INDEX]
SCALED = "scaled_features"


def status_indexer(column: str = "order_status", output: str = STATUS_INDEX) -> StringIndexer:
    """Most frequent status first, equal counts by name; unseen statuses drop the row."""
    return StringIndexer(
        inputCol=column,
        outputCol=output,
        handleInvalid="skip",
        stringOrderType="frequencyDesc",
    )


def feature_stages(
    columns: Sequence[str] = FEATURE_NAMES, output: str = SCALED
) -> list[Transformer]:
    """Index the status, assemble the columns, scale to zero mean and unit deviation."""
    return [
        status_indexer(),
        VectorAssembler(inputCols=list(columns), outputCol="features"),
        StandardScaler(inputCol="features", outputCol=output, withMean=True, withStd=True),
    ]


def scaled_features(frame: DataFrame, columns: Sequence[str] = FEATURE_NAMES) -> DataFrame:
    """Fits the feature stages on the frame and adds their columns to it."""
    return Pipeline(stages=feature_stages(columns)).fit(frame).transform(frame)


def vector_columns(frame: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """Replaces a vector column by one double column per position."""
    values = vector_to_array(F.col(vector))
    rest = [name for name in frame.columns if name != vector]
    return frame.select(*rest, *(values[i].alias(name) for i, name in enumerate(names)))


def on_train_side(key: str | Column, train_share: float = 0.8, buckets: int = 10) -> Column:
    """Whether a row belongs to the training side: by a hash of its key, and never null.

    A row keeps its side whatever the partitioning of the frame, the cluster or a rerun.
    Rows without a key are trained on.
    """
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(key_bucket(key, buckets) < round(train_share * buckets), F.lit(True))


def split_by_key(
    frame: DataFrame, key: str | Column, train_share: float = 0.8, buckets: int = 10
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by :func:`on_train_side`; each row is on one of the sides."""
    in_train = on_train_side(key, train_share, buckets)
    return frame.where(in_train), frame.where(~in_train)


def split_at_random(
    frame: DataFrame, train_share: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Spark's seeded split; the sides change with the partitioning of the frame."""
    train, test = frame.randomSplit([train_share, 1.0 - train_share], seed=seed)
    return train, test

"""Row-wise operators: projection, filter, expansion, null handling, labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def project(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.select(*columns)


def keyed_sum(frame: DataFrame, key: str, addends: Sequence[str], name: str) -> DataFrame:
    """Pairs of ``key`` and the sum of the ``addends`` of the same row."""
    total = F.col(addends[0])
    for addend in addends[1:]:
        total = total + F.col(addend)
    return frame.select(key, total.alias(name))


def above(frame: DataFrame, column: str, threshold: float) -> DataFrame:
    return frame.where(F.col(column) > threshold)


def expand_columns(frame: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """One output row per listed column of each input row; the columns share one type."""
    return frame.select(F.explode(F.array(*columns)).alias(name))


def drop_incomplete(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    return frame.na.drop(subset=list(columns))


def label_at_least(frame: DataFrame, column: str, threshold: float, name: str) -> DataFrame:
    """Adds 1.0 where ``column`` reaches the threshold, else 0.0."""
    return frame.withColumn(name, F.when(F.col(column) >= threshold, 1.0).otherwise(0.0))

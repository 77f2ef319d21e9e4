"""Aggregations. All of them combine rows before the shuffle, so a hot key stays cheap."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.money import ExactSum


def count_per_key(frame: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return frame.groupBy(*keys).agg(F.count("*").alias(name))


def sum_per_key(frame: DataFrame, key: str, amount: str, name: str) -> DataFrame:
    """Sum per key of a currency amount, given as SQL text, rounded to cents."""
    amount_sum = ExactSum("amount")
    return (
        frame.select(key, *amount_sum.split(amount))
        .groupBy(key)
        .agg(*amount_sum.sums())
        .select(key, amount_sum.rounded().alias(name))
    )


def distinct_values(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.select(*columns).distinct()


def numeric_summary(frame: DataFrame, column: str) -> DataFrame:
    """Count, sum, mean, sample deviation, minimum and maximum of a currency column."""
    value = F.col(column)
    value_sum = ExactSum("value")
    return frame.select(column, *value_sum.split(column)).agg(
        F.count(value).alias("n_values"),
        *value_sum.sums(),
        F.stddev_samp(value).alias("deviation"),
        F.min(value).alias("lowest"),
        F.max(value).alias("highest"),
    ).select(
        "n_values",
        value_sum.rounded().alias("sum_value"),
        value_sum.mean("n_values").alias("avg_value"),
        F.round("deviation", 2).alias("stddev_value"),
        F.round("lowest", 2).alias("min_value"),
        F.round("highest", 2).alias("max_value"),
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table; a Parquet count reads no column data."""
    counts = [
        frame.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, frame in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result

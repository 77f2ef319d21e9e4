"""Schemas and plans as data."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_schemas(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Position, name and type of each column of each table, with the table's row count."""
    described = []
    for name, frame in tables.items():
        fields = F.array(
            *(
                F.struct(
                    F.lit(position).alias("position"),
                    F.lit(field.name).alias("col_name"),
                    F.lit(field.dataType.simpleString()).alias("data_type"),
                )
                for position, field in enumerate(frame.schema.fields, start=1)
            )
        )
        described.append(
            frame.agg(F.count("*").alias("n_rows")).select(
                F.lit(name).alias("table_name"), F.inline(fields), "n_rows"
            )
        )
    result = described[0]
    for other in described[1:]:
        result = result.unionByName(other)
    return result


def describe_view(frame: DataFrame) -> DataFrame:
    """``DESCRIBE`` of the frame as a view: col_name, data_type, comment."""
    return _about(frame, "DESCRIBE {}")


def explain_view(frame: DataFrame) -> DataFrame:
    """The parsed, analysed, optimised and physical plan in one ``plan`` column."""
    return _about(frame, "EXPLAIN EXTENDED SELECT * FROM {}")


def _about(frame: DataFrame, statement: str) -> DataFrame:
    """The answer to a statement about the frame, whose view is gone afterwards."""
    spark, view = frame.sparkSession, f"tillroll_{uuid.uuid4().hex}"
    frame.createOrReplaceTempView(view)
    try:
        # these statements are answered at once
        answer = spark.sql(statement.format(view))
        return spark.createDataFrame(answer.collect(), answer.schema)
    finally:
        spark.catalog.dropTempView(view)

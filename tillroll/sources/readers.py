"""Text, CSV and Parquet readers.

CSV is the landing format only. Reading it with ``multi_line`` keeps each file in one
task, so a large table should arrive as many files and be stored as Parquet once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per physical line in a ``value`` column, header lines included."""
    return spark.read.text(path)


def read_csv_inferred(
    spark: SparkSession, path: str, multi_line: bool = False, escape: str = '"'
) -> DataFrame:
    """CSV with a header and types inferred from the whole data, which costs a second pass."""
    return _csv(spark, multi_line, escape).option("inferSchema", True).csv(path)


def read_csv_typed(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    multi_line: bool = True,
    escape: str = '"',
) -> DataFrame:
    """CSV with a header and a fixed schema; a value of the wrong type becomes null.

    ``multi_line=True`` keeps quoted line breaks inside one field. ``multi_line=False``
    splits a record at each line break, and lets files be split among tasks. Either way a
    doubled quote stands for a quote; ``escape="\\\\"`` reads backslash escapes instead.
    """
    return _csv(spark, multi_line, escape).schema(schema).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _csv(spark: SparkSession, multi_line: bool, escape: str):
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    return reader.option("escape", escape).option("multiLine", multi_line)

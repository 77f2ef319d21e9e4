"""Writers, and the listing of what they wrote."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(
    frame: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> str:
    """Writes ``frame`` as Parquet, replacing the folder, and returns the path."""
    writer = frame.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_bucketed(frame: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Writes ``frame`` as a Parquet table bucketed by ``key``, and returns the table.

    Tables with the same number of buckets are grouped by and joined on ``key`` without a
    shuffle. A bucket is read by one task, so ``key`` must not be hot in the table. The
    bucketing is known to sessions that share the catalogue the table is saved in. A table
    of that name is replaced only if it lies at ``path``; any other is an error.
    """
    spark = frame.sparkSession
    if spark.catalog.tableExists(table) and _location(spark, table) != _qualified(spark, path):
        raise ValueError(f"table {table} exists at another place than {path}")
    (
        frame.repartition(buckets, key)
        .write.mode("overwrite")
        .format("parquet")
        .option("path", path)
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(table)
    )
    return spark.table(table)


def _location(spark: SparkSession, table: str) -> str:
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
    return _qualified(spark, found["data_type"]) if found else ""


def _qualified(spark: SparkSession, path: str) -> str:
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(context._jsc.hadoopConfiguration())
    return files.makeQualified(place).toString()


def write_csv(frame: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Writes ``frame`` as CSV that :func:`read_csv_typed` reads back unchanged."""
    (
        frame.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def sink_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Name, bytes and rows of each file below a Parquet folder.

    Only file footers are read, so this also replaces a ``count()`` after a write, which
    would compute the written plan again.
    """
    return (
        spark.read.parquet(path)
        .groupBy(
            F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.file_size").alias("file_bytes"),
        )
        .agg(F.count("*").alias("n_rows"))
    )

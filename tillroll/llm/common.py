"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.sources.session import shared_folder

#: Rows up to which a frame that was counted first may be broadcast.
BROADCAST_ROWS = 20_000


#: Folder that holds the package.
_ROOT = str(Path(__file__).parents[2])


def map_batches(frame: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` by functions of this package.

    Python workers on machines that see the driver's folder find the package there; elsewhere
    it has to be installed or sent with ``--py-files``.
    """
    environment = frame.sparkSession.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in known:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [_ROOT, *known]))
    return frame.mapInArrow(function, schema)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read again: its lineage ends there."""
    path = shared_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def join_counted(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """A join that broadcasts a right side of at most ``BROADCAST_ROWS`` counted rows."""
    if right.count() <= BROADCAST_ROWS:
        right = F.broadcast(right)
    return left.join(right, on, how)


#: Rows of a key that one task takes in a spread join, unless more keys exceed it than
#: ``HOT_KEYS``: then those with the most rows are spread, and the list has this bound.
KEY_ROWS = 1 << 10
HOT_KEYS = 10_000


def join_spread(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    spread: Column,
    how: str = "inner",
    key_rows: int = KEY_ROWS,
) -> DataFrame:
    """An inner or left join of many rows with one or few rows a key, such as a lookup.

    Keys that ``left`` has often are counted first; their rows are dealt out by the hash
    ``spread`` over several salts, and the few rows of ``right`` are repeated for each. The
    list of these keys is broadcast; it has at most ``HOT_KEYS`` rows.
    """
    beyond = left.where(" AND ".join(f"`{name}` IS NOT NULL" for name in on)).groupBy(*on)
    beyond = beyond.agg(F.count("*").alias("_rows")).where(F.col("_rows") > key_rows)
    hot = stored(beyond.orderBy(F.desc("_rows"), *on).limit(HOT_KEYS), "hot-keys")
    hot = F.broadcast(hot.select(*on, F.ceil(F.col("_rows") / key_rows).cast("int").alias("_salts")))
    salts = F.coalesce("_salts", F.lit(1))
    dealt = left.join(hot, on, "left").withColumn("_salt", F.pmod(spread, salts).cast("int")).drop("_salts")
    copied = (
        right.join(hot, on, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    )
    return dealt.join(copied, [*on, "_salt"], how).drop("_salt")


def fold(id_column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.pmod(F.crc32(F.col(id_column).cast("string")), F.lit(modulus))


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to at most ``rows`` rows, so that a task holds few texts at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """Strings of an Arrow column as UTF-8, without decoding them."""
    return column.cast(pa.large_binary()).to_pylist()


def bounded_sample(frame: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows: those with the smallest hashes of the ``key`` column.

    A count first narrows the hashes to about twice as many rows, so that tasks do not each
    keep ``rows`` of them; if that leaves too few, all rows are considered.
    """
    slots = 1 << 40
    share = min(1.0, 2 * rows / max(1, frame.count()))
    hashed = F.xxhash64(key)
    near = frame.where(F.pmod(hashed, F.lit(slots)) < int(share * slots))
    if share < 1 and near.limit(rows).count() < rows:
        near = frame
    return near.orderBy(F.pmod(hashed, F.lit(slots)), hashed).limit(rows)

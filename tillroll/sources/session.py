"""Helpers around a session that belongs to the caller."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def session_facts(spark: SparkSession) -> dict[str, str | int]:
    context = spark.sparkContext
    return {
        "app_name": context.appName,
        "spark_version": spark.version,
        "master": context.master,
        "default_parallelism": context.defaultParallelism,
    }


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Makes each frame known to SQL text under ``prefix + name``."""
    for name, frame in tables.items():
        frame.createOrReplaceTempView(prefix + name)


@contextmanager
def persisted(
    *frames: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK
) -> Iterator[tuple[DataFrame, ...]]:
    """Keeps frames that are read more than once, and releases them at the end."""
    kept = tuple(frame.persist(level) for frame in frames)
    try:
        yield kept
    finally:
        for frame in kept:
            frame.unpersist()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the session's scratch folder, which all nodes of the cluster see.

    The scratch folder lies in the folder named by ``spark.checkpoint.dir``, is made with
    the first path and deleted when the driver ends. Only a local session, whose executors
    share the driver's disk, may go without the setting: it takes its warehouse folder.
    """
    return f"{_scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _scratch_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_SETTING} must name a folder shared by all nodes")
        root = spark.conf.get("spark.sql.warehouse.dir")
    scratch = f"{root.rstrip('/')}/tillroll-{context.applicationId}"
    path, files = _files(spark, scratch)
    if not files.exists(path):
        files.mkdirs(path)
        files.deleteOnExit(path)
    return scratch


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _files(spark, path)
    return files.exists(place)


def file_stamps(spark: SparkSession, paths: list[str]) -> tuple[tuple[str, int, int], ...]:
    """Path, size and time of change of files, in order: one listing for each folder.

    ``paths`` are URIs as a frame's ``inputFiles`` gives them.
    """
    places = {unquote(path) for path in paths}
    found = []
    for folder in sorted({path.rpartition("/")[0] for path in places}):
        place, files = _files(spark, folder)
        for status in files.listStatus(place):
            found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    same = lambda path: path.partition(":")[2].lstrip("/")
    named = {same(path): path for path in places}
    return tuple(sorted((named[same(p)], n, t) for p, n, t in found if same(p) in named))


def release_scratch(spark: SparkSession) -> None:
    """Deletes what the session has written to its scratch folder so far."""
    path, files = _files(spark, _scratch_folder(spark))
    for status in files.listStatus(path):
        files.delete(status.getPath(), True)


def _files(spark: SparkSession, path: str):
    """A path and the file system that it is in, which may be any that Hadoop knows."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(context._jsc.hadoopConfiguration())

"""Small file-system helpers that work on any store Spark can reach."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

_DELETED_AT_ONCE = 16


def _resolve(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, uri: str) -> bool:
    path, fs = _resolve(spark, uri)
    return fs.exists(path)


def temporary_folder(spark: SparkSession, uri: str) -> str:
    """Make a folder that is removed when the application ends."""
    path, fs = _resolve(spark, uri)
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return uri


def delete(spark: SparkSession, uri: str) -> bool:
    """Remove a file or a whole folder; False when there was nothing."""
    path, fs = _resolve(spark, uri)
    return fs.delete(path, True)


def files_in(spark: SparkSession, uri: str) -> list[str]:
    """The data files of one folder, by their full addresses; none where there is no folder."""
    path, fs = _resolve(spark, uri)
    if not fs.exists(path):
        return []
    listed = [status.getPath() for status in fs.listStatus(path) if status.isFile()]
    return [found.toString() for found in listed if not found.getName().startswith(("_", "."))]


def delete_all(spark: SparkSession, uris: Sequence[str]) -> int:
    """Remove files, several at a time; how many were there."""
    if not uris:
        return 0
    with ThreadPoolExecutor(max_workers=_DELETED_AT_ONCE) as pool:
        return sum(pool.map(lambda uri: delete(spark, uri), uris))


def qualified(spark: SparkSession, uri: str) -> str:
    """The full address of a file or folder, as listings spell it."""
    path, fs = _resolve(spark, uri)
    return fs.makeQualified(path).toString()


def total_bytes(spark: SparkSession, uri: str) -> int:
    path, fs = _resolve(spark, uri)
    return fs.getContentSummary(path).getLength()

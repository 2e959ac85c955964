"""Files and folders by path, on whatever file system the path names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    located = spark._jvm.org.apache.hadoop.fs.Path(path)
    return located, located.getFileSystem(spark._jsc.hadoopConfiguration())


def present(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """Those of ``paths`` that exist. One look per path, no listing."""
    found = []
    for path in paths:
        located, files = _located(spark, path)
        if files.exists(located):
            found.append(path)
    return found


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; none if there is no such folder."""
    located, files = _located(spark, path)
    if not files.exists(located):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(located) if s.isDirectory())


def remove_files(spark: SparkSession, paths: Iterable[str]) -> int:
    """Remove files or folders by path; how many were there."""
    removed = 0
    for path in paths:
        located, files = _located(spark, path)
        removed += bool(files.delete(located, True))
    return removed

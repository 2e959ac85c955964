"""One run at a time: a claim on a table that a second run cannot take."""

from __future__ import annotations

import logging
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

CLAIM = "claim"


class AlreadyClaimed(RuntimeError):
    """Another run has the table."""


def _file(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{CLAIM}")
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def holder(spark: SparkSession, root: str) -> str | None:
    """The run that has the table, or NULL."""
    path, files = _file(spark, root)
    if not files.exists(path):
        return None
    stream = files.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def release(spark: SparkSession, root: str) -> None:
    """Give the table up, also for a run whose driver was killed."""
    path, files = _file(spark, root)
    files.delete(path, False)


@contextmanager
def claim(spark: SparkSession, root: str, run_id: str) -> Iterator[None]:
    """Hold the table at ``root`` for a run, or raise :class:`AlreadyClaimed`.

    The claim is a file that is created only if it is absent, which the file
    system decides. It names the run. One left over by a killed driver stays
    until :func:`release` is called: only an operator knows that it is dead.
    """
    path, files = _file(spark, root)
    try:
        stream = files.create(path, False)
    except Py4JJavaError as error:
        if not files.exists(path):
            raise
        raise AlreadyClaimed(f"{root} is claimed by run {holder(spark, root)}") from error
    try:
        stream.write(bytearray(run_id.encode()))
    finally:
        stream.close()
    try:
        yield
    finally:
        try:
            release(spark, root)
        except Py4JJavaError as error:
            log.warning("the claim on %s stays: %s", root, error)

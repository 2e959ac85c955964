"""Session settings the jobs are tuned for, and the shared scratch folder."""

from __future__ import annotations

import logging
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from tidemark.sources.files import remove_files

log = logging.getLogger(__name__)

# Where scratch tables of the run at hand lie, if it has a folder of its own.
_RUN_FOLDER: ContextVar[str | None] = ContextVar("run_folder", default=None)

SETTINGS = {
    # Times are stored and shown in UTC; only the derived date is local.
    "spark.sql.session.timeZone": "UTC",
    # Adaptive execution splits hot join partitions and over-full output
    # partitions, and merges the small ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Above 2,000 shuffle partitions a map task reports only the average of its
    # block sizes. This makes it report blocks five times the median exactly,
    # or adaptive execution could not see a hot key.
    "spark.shuffle.accurateBlockSkewedFactor": "5.0",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.mergeSchema": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# A shuffled event takes about 100 bytes.
SHUFFLED_ROW_BYTES = 100
SHUFFLE_PARTITION_BYTES = 512 * 1024 * 1024


def shuffle_partitions(rows: int, row_bytes: int = SHUFFLED_ROW_BYTES) -> int:
    """Width for a full-row shuffle of so many rows; it grows with them."""
    return max(-(-rows * row_bytes // SHUFFLE_PARTITION_BYTES), 1)


@contextmanager
def shuffle_width(spark: SparkSession, rows: int) -> Iterator[None]:
    """Make the session's shuffles wide enough for ``rows`` events meanwhile.

    Never narrower than the session asks for. Adaptive execution merges what
    turns out small.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(int(before), shuffle_partitions(rows))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def build_session(
    app_name: str = "tidemark",
    master: str | None = None,
    extra: dict[str, str] | None = None,
    events: int | None = None,
    hive: bool = False,
) -> SparkSession:
    """A session with the settings above; ``extra`` wins over them.

    ``events`` is about how many rows the largest input has; it sets the width
    of the shuffles, which adaptive execution only ever makes narrower. Give it
    wherever the library's functions are called outside the batch job, which
    sets the width itself. With ``hive`` tables are kept in the metastore that
    the cluster's configuration names, so they outlive the session.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if hive:
        builder = builder.enableHiveSupport()
    settings = dict(SETTINGS)
    if events is not None:
        settings["spark.sql.shuffle.partitions"] = str(max(shuffle_partitions(events), 200))
    for key, value in {**settings, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once per application.

    For functions that run there, where the package is not installed. The
    archive is read by the driver alone, which serves it to the executors.
    """
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark")
        context.addPyFile(shutil.make_archive(archive, "zip", root, "tidemark"))
        _SHIPPED.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster shares for intermediate tables.

    ``spark.checkpoint.dir`` names it. Where the setting is absent a local
    session, as in tests, gets a temporary folder of this machine; on a cluster
    that is an error, for executors would not see each other's files.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        master = context.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="tidemark-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    folder = _RUN_FOLDER.get() or f"{shared_dir(spark)}/tidemark"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """A folder for all scratch tables written meanwhile, deleted at the end.

    Results are lazy and may read such tables, so write or collect them inside.
    The folder goes by path, also after a failure; if it cannot go, that is logged; a run within a run has a
    folder inside the outer one. Yields the folder.
    """
    folder = scratch_path(spark, "run")
    before = _RUN_FOLDER.set(folder)
    try:
        yield folder
    finally:
        _RUN_FOLDER.reset(before)
        try:
            remove_files(spark, [folder])
        except Py4JJavaError as error:
            log.warning("scratch tables in %s stay: %s", folder, error)

from __future__ import annotations

import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from tidemark.schema import RAW_EVENTS  # noqa: E402
from tidemark.session import build_session  # noqa: E402
from timing import utc  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tidemark-tests",
        master="local[8]",
        extra={
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.warehouse.dir": f"file://{folder}/warehouse",
            "spark.checkpoint.dir": f"file://{folder}/checkpoint",
            "spark.log.level": "ERROR",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def set_all(**options):
        for key, value in options.items():
            name = key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield set_all
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.fixture
def events(spark):
    """Raw events from (user, time text) pairs; the product numbers the rows."""

    def build(*rows):
        return spark.createDataFrame(
            [
                (None if t is None else utc(t), "view", i, 2**40, None, None, 1.0, u, None)
                for i, (u, t) in enumerate(rows)
            ],
            RAW_EVENTS,
        )

    return build

from __future__ import annotations

import pytest


@pytest.fixture(autouse=True)
def narrow(spark):
    """Small tables need few tasks."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)

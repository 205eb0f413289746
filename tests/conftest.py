from __future__ import annotations

import itertools
import os
import sys
import uuid
from datetime import datetime, timedelta, timezone

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from saleslake.plans.lake import Lake  # noqa: E402
from saleslake.session import build_session  # noqa: E402

START = datetime(2024, 7, 21, 10, 35, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "saleslake-tests",
        master="local[4]",
        shuffle_partitions=4,
        **{
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(shared / "warehouse"),
            "spark.checkpoint.dir": str(shared / "work"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"), f"_{uuid.uuid4().hex[:10]}").create()


@pytest.fixture
def clock():
    """Run times, an hour apart."""
    return (START + timedelta(hours=n) for n in itertools.count())

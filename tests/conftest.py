"""One local Spark session for all tests."""

from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderloom.session import build_session  # noqa: E402


def local_session():
    spark = build_session(
        "orderloom tests",
        master="local[8]",
        shuffle_partitions=8,
        conf={
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="orderloom-tests-"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    yield session
    session.stop()

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripfold.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("tripfold-tests", master="local[*]",
                      conf={"spark.sql.shuffle.partitions": "8",
                            "spark.sql.session.timeZone": "UTC"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def scratch(spark, tmp_path):
    """A fresh folder for tables written by a test."""
    return str(tmp_path)

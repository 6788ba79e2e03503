import os
import sys
import tempfile
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from touchline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    shared = os.path.join(tempfile.gettempdir(), f"touchline-tests-{uuid.uuid4().hex}")
    session = build_session(
        "touchline-tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": shared,
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    """A fresh folder for one test."""
    return str(tmp_path)

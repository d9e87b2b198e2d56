import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        master="local[8]",
        shuffle_partitions=8,
        **{
            "spark.checkpoint.dir": str(base / "work"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

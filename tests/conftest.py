import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gaugeflow.session import build_session, ship_code  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    ship_code()
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": 4,
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.driver.memory": "4g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

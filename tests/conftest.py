import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ticketry.session import get_spark

    conf = {"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"}
    session = get_spark("tests", "local[8]", **conf)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture()
def folder():
    return FOLDER


@pytest.fixture()
def base(tmp_path):
    return str(tmp_path / "lake")

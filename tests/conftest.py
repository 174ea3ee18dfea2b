import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from paneloom.session import build_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]",
        "paneloom-tests",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="6g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR

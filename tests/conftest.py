import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from winnowry.session import build_session

    session = build_session("local[8]", app="tests", **{
        "spark__ui__enabled": "false", "spark__ui__showConsoleProgress": "false",
        "spark__sql__shuffle__partitions": "8", "spark__driver__memory": "6g",
        "spark__checkpoint__dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR

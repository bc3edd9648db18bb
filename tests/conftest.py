import os

import pytest

from tabprep.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", 8, spark__ui__enabled="false", spark__driver__memory="4g"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return os.environ.get("TABPREP_TEST_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def root(tmp_path):
    """A fresh folder for tables a test writes."""
    return str(tmp_path)

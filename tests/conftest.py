import os
import tempfile

import pytest

from tidebars.session import get_session

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests", master="local[4]", spark__sql__shuffle__partitions=4, spark__driver__memory="4g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="tidebars-test-"),
        spark__local__dir=tempfile.mkdtemp(prefix="tidebars-local-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="tidebars-case-")


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", SF_SMALL)

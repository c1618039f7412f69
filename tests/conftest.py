import os
import tempfile

import pytest

from ebbline.session import build_session

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", master="local[8]", shuffle_partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ebbline-tests-"))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return DATA

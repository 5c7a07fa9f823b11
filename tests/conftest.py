import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from larder.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("larder-tests", cpus=8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_data():
    return SMALL


@pytest.fixture(scope="session")
def frame(spark):
    """Build a frame from rows and a schema text."""

    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make

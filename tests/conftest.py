import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from ramparts.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8,
        "ramparts-tests",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__maxMetadataStringLength="10000",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""

    def collect(frame, *columns):
        chosen = frame.select(*columns) if columns else frame
        return sorted((tuple(row) for row in chosen.collect()), key=repr)

    return collect


@pytest.fixture
def plan():
    """Physical plan of a frame as text."""

    def text(frame):
        return frame._jdf.queryExecution().executedPlan().toString()

    return text

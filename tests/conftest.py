"""One local session for all tests, and the smallest data folder."""

import os

import pytest

from firngrid.session import local_session

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    """A session with few shuffle partitions."""
    session = local_session(cores=4, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    """The smallest tables."""
    if not os.path.isdir(DATA):
        pytest.skip("no test tables here")
    return DATA

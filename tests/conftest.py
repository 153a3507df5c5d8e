import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from roadwatch.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def pytest_addoption(parser):
    parser.addoption("--sf", default="0.01", help="scale factor for the SQL comparison")


@pytest.fixture(scope="session")
def sf_dir(request):
    return f"/root/testdata/sf{request.config.getoption('--sf')}"

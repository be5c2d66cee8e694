import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MED = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from spokewise.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def workdir(spark):
    from spokewise.session import new_workdir
    return new_workdir(spark, "test")


@pytest.fixture()
def localdir():
    """A local folder for hand-written edge files (tests only)."""
    return tempfile.mkdtemp(prefix="spokewise-edge-")

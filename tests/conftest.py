import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from recbrook.session import build_session
    s = build_session("local[4]", app="recbrook-tests", shuffle_partitions=4)
    yield s
    s.stop()

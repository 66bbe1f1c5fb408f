import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from terrace.session import build_session

    s = build_session("terrace-tests", master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()

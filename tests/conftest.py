import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from metrolens.session import build_session

    session = build_session("local[4]", "metrolens-tests", shuffle_partitions=8)
    yield session
    session.stop()

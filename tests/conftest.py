import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from locusframe.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def registry():
    from locusframe.catalog import load_all
    return load_all()


@pytest.fixture(scope="session")
def duck():
    sys.path.insert(0, os.path.join(ROOT, "tools"))
    from oracle_check import duck as mk
    return mk(SF_SMALL)

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ticketlens.session import local_session

    session = local_session("*", shuffle_partitions=8, app="ticketlens-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SMOKE_DIR):
        pytest.skip("test tables not available")
    return SMOKE_DIR

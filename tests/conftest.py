import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_session
    s = get_session("local[4]", 4)
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.exists(f"{SMALL}/events.parquet"):
        pytest.skip("test data missing")
    return SMALL

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from textspark.session import build_session, ensure_checkpoint_dir
    s = build_session("local[4]", shuffle_partitions=8)
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return SMOKE

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rollcall.session import build_session, checkpoint_root  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=8)
    checkpoint_root(s)  # local mode: a private folder, since none is configured
    yield s

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from scorebook.session import build_session, checkpoint_dir

    s = build_session("local[4]", app="scorebook-tests", shuffle_partitions=8)
    checkpoint_dir(s)
    yield s
    s.stop()

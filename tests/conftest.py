import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lakemart.session import build_session, checkpoint_root
    s = build_session("local[*]", app_name="lakemart-tests", shuffle_partitions=8)
    checkpoint_root(s)  # sets a private folder only when the session names none
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    sys.path.insert(0, os.path.join(ROOT, "tools"))
    from check_oracle import duck as make
    return make

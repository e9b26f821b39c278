import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from shelfcast.session import build_session
    s = build_session("local[4]", 8, app_name="shelfcast-tests")
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quern.session import checkpoint_root, local_session

    s = local_session(4, shuffle_partitions=4, app="quern-tests")
    checkpoint_root(s)  # sets a private folder only when the session has none
    yield s
    s.stop()

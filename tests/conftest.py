import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from retailcast.session import local_session
    s = local_session("*", shuffle_partitions=8, driver_memory="4g")
    yield s
    s.stop()

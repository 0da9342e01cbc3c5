import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app="tessera-tests", shuffle_partitions=4, driver_memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()

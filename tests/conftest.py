import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from onomata.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, memory="4g")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="onomata-tests-"))
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"

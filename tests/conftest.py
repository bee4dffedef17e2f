import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ordermart.session import build_session
    s = build_session("local[4]", app="ordermart-tests", shuffle_partitions=8)
    if s.sparkContext.getCheckpointDir() is None and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ordermart-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="ordermart-test-")

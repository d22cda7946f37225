import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from chatloom.session import get_spark
    s = get_spark("local[4]", "chatloom-tests", {"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_fresh():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="chatloom-test-", dir="/tmp")


SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

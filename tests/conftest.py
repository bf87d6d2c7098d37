from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from navforge.session import build_session

    warehouse = tempfile.mkdtemp(prefix="navforge-warehouse-")  # catalog tables of the tests
    s = build_session(master="local[*]", shuffle_partitions=8, app_name="navforge-tests",
                      extra={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="navforge-test-")

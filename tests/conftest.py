from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from monthledger.session import local_session

    s = local_session("local[8]", "monthledger-tests", **{"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


@pytest.fixture(autouse=True)
def no_views_left():
    """A test's temporary views do not show in the next one's catalogue."""
    yield
    from pyspark.sql import SparkSession

    s = SparkSession.getActiveSession()
    for t in s.catalog.listTables() if s else []:
        if t.isTemporary:
            s.catalog.dropTempView(t.name)

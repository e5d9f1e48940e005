from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from plantlens.session import build_session

    s = build_session("local[4]", shuffle_partitions=4, app_name="plantlens-tests",
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="plantlens-wh-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="plantlens-test-")

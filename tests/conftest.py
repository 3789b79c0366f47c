from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lexmill.session import local_session

    session = local_session(cores=8, shuffle_partitions=4, memory="8g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small() -> str:
    return SMALL

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from sparkmart.session import build_session

    session = build_session(master="local[*]", shuffle_partitions=8, app_name="sparkmart-tests", driver_memory="8g")
    yield session
    session.stop()
